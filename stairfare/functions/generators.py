"""Row-generating functions: facts of panel lines that take more than one pattern."""

import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[;:/]")
TOPICS = {"change": "date_change", "reissue": "date_change", "refund": "refund", "cancel": "refund", "cancellation": "refund"}
REFUSED, FREE = {"not", "non", "no"}, {"free", "included"}


def number_facts(line: Column) -> Column:
    """Every number of a line with the word before it: array<struct<fact, value>>."""
    found = F.regexp_extract_all(F.coalesce(line, F.lit("")), F.lit(r"(\p{L}*[^\p{L}\d]*?\d+)"), F.lit(1))
    return F.transform(found, lambda m: F.struct(
        F.lower(F.regexp_extract(m, r"^(\p{L}*)", 1)).alias("fact"), F.regexp_extract(m, r"(\d+)$", 1).alias("value")))


def penalties(line: str) -> list[tuple[str, str, str]]:
    """``(topic, phase, outcome)`` of a line about fees before and after departure.

    The words are read in order.  A topic or a phase holds until the next one; an amount, a refusal or "free" is the
    outcome of the topic and phase in force.  An outcome met before any phase waits: a phase that follows at once is
    its own, else it holds for both.  A semicolon forgets topic and phase.
    """
    out, topic, phase, refused, waiting = [], None, None, False, None

    def settle(phases=("before", "after")):
        if waiting:
            out.extend((waiting[0], p, waiting[1]) for p in phases)

    for word in map(str.lower, _TOKEN.findall(line or "")):
        if word in ("before", "after"):
            settle((word,))
            waiting, phase, refused = None, word, False
        elif word == ";" or word in TOPICS:
            settle()
            waiting, refused = None, False
            topic, phase = (None, None) if word == ";" else (TOPICS[word], phase)
        elif word in REFUSED:
            refused = True
        elif word == "refundable" or topic and (word[0].isdigit() or word in FREE or refused and word in ("permitted", "allowed")):
            settle()
            topic = "refund" if word == "refundable" else topic
            outcome = "Not Included" if refused else word.replace(",", "") if word[0].isdigit() else "Included"
            waiting, refused = (topic, outcome), False
            if phase:
                settle((phase,))
                waiting = None
    settle()
    return out


@F.arrow_udtf(returnType="line string, n bigint, topic string, phase string, outcome string")
class penalty_facts:
    """The facts of ``penalties`` for a table of distinct lines with their counts, a batch at a time."""

    def eval(self, batch: pa.RecordBatch):
        rows = [(line, n, *fact) for line, n in zip(batch.column("line").to_pylist(), batch.column("n").to_pylist()) for fact in penalties(line)]
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.table({name: pa.array(c, t) for name, c, t in zip(("line", "n", "topic", "phase", "outcome"), columns, types)})
