"""Chat formatting at token level.

The fare library has no conversations, so this operator is general: it takes any table of turns.

A turn's text and its frame never meet as text.  The text is encoded by itself, the frame's control
strings are single reserved ids beyond the vocabulary, and the two are spliced:

    user        [INST] text [/INST]
    assistant   text </s>
    other role  <s> role [ROLE] text </s>

Control strings inside a text are escaped, so that they stay apart from the frame's in the rendered
string too; the escape is reversible.  The loss mask is the running sum of +1 where an assistant's text
begins and -1 where it ends.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import tokens

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]"]
#: A control string with any number of backslashes behind its first character.
_CONTROL_LIKE = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|ROLE\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|ROLE\])")


def escape(text: str) -> str:
    return _CONTROL_LIKE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def reserved(path: str) -> dict[str, int]:
    """Control string to id, counted on from the size of the vocabulary."""
    size = tokens.encoder(path).tokenizer.get_vocab_size()
    return {c: size + i for i, c in enumerate(CONTROL)}


def assemble(turns: list[tuple[str | None, str, np.ndarray, np.ndarray]], ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one conversation from ``(role, role text, role ids, text ids)`` per turn."""
    parts, edges, at = [], [], 0
    for role, _, role_ids, text_ids in turns:
        if role == "user":
            head, tail = [ids["[INST]"]], [ids["[/INST]"]]
        elif role == "assistant":
            head, tail = [], [ids["</s>"]]
        else:
            head, tail = [ids["<s>"], *role_ids.tolist(), ids["[ROLE]"]], [ids["</s>"]]
        if role == "assistant":
            edges.append((at, at + len(text_ids)))
        parts += [np.array(head, np.uint32), text_ids, np.array(tail, np.uint32)]
        at += len(head) + len(text_ids) + len(tail)
    step = np.zeros(at + 1, np.int32)
    for lo, hi in edges:
        step[lo] += 1
        step[hi] -= 1
    return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), np.cumsum(step[:-1]).astype(bool)


class Read:
    """Formatted conversations, from their ids and masks alone; every stretch of text is decoded once for all of them."""

    def __init__(self, sequences: list[np.ndarray], path: str):
        self.signs = {v: k for k, v in reserved(path).items()}
        least = min(self.signs)
        self.sequences = sequences
        self.cuts = [np.flatnonzero(s >= least).tolist() for s in sequences]
        stretches = [s[lo:hi].tolist() for s, cut in zip(sequences, self.cuts) for lo, hi in zip([0, *(c + 1 for c in cut)], [*cut, len(s)])]
        decoded = iter(tokens.encoder(path).tokenizer.decode_batch(stretches, skip_special_tokens=False))
        self.texts = [[next(decoded) for _ in range(len(cut) + 1)] for cut in self.cuts]

    def rendered(self, i: int) -> str:
        """The string the ids stand for, control strings included."""
        signs = [self.signs[int(self.sequences[i][c])] for c in self.cuts[i]]
        return "".join(x for pair in zip(self.texts[i], [*signs, ""]) for x in pair)

    def turns(self, i: int) -> list[tuple[str, str]]:
        """``(role, text)`` of each turn; null roles come back as empty ones."""
        out, role = [], "assistant"
        for c, raw in zip(self.cuts[i], self.texts[i]):
            sign = self.signs[int(self.sequences[i][c])]
            if sign == "[ROLE]":
                role = unescape(raw)
            elif sign == "[INST]":
                role = "user"
            elif sign in ("[/INST]", "</s>"):
                out.append((role, unescape(raw)))
                role = "assistant"
        return out

    def masked(self, i: int, mask: np.ndarray) -> list[str]:
        """Texts of the runs under the mask, unescaped; a run is one stretch, since frames are not masked."""
        starts = {lo: text for lo, text in zip([0, *(c + 1 for c in self.cuts[i])], self.texts[i])}
        edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
        return [unescape(starts[lo]) for lo in np.flatnonzero(edge == 1).tolist()]


OUTPUT = "conv_id {kind}, n_turns long, ids binary, loss_mask binary, formatted_chars long"


def format_turns(turns: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, ids, loss_mask, formatted_chars``.

    ``ids`` are little-endian 32-bit integers, reserved ones included; ``loss_mask`` has a byte per id, 1
    on the texts of assistant turns; ``formatted_chars`` are the code points of the rendered string.

    Turns are ordered by ``turn``, nulls first, ties by role and text; repeated rows are turns each.  A
    null text is empty; a null or empty role is a role without a name.  Rows without a conversation id
    are one conversation.  An empty table gives an empty one; other columns are not read.  The turns of
    one conversation are one output record and meet in one task; conversations are spread by id.
    """
    kind = turns.schema[conv].dataType
    plain = turns.select(F.col(f"`{conv}`").cast("string").alias("__conv"), F.col(f"`{turn}`").alias("__turn"),
                         F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("__role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    whole = plain.groupBy("__conv").agg(F.array_sort(F.collect_list(F.struct("__turn", "__role", "__text"))).alias("__turns")) \
        .withColumn("__turns", F.concat(F.filter("__turns", lambda t: t["__turn"].isNull()), F.filter("__turns", lambda t: t["__turn"].isNotNull()))) \
        .select("__conv", F.col("__turns.__role").alias("roles"), F.col("__turns.__text").alias("texts"))

    def run(batches):
        ids = reserved(tokenizer)
        encode = tokens.encoder(tokenizer).encode
        for pdf in batches:
            for at in range(0, len(pdf), 100):
                part = pdf.iloc[at:at + 100]
                flat = [escape(t) for ts in part["texts"] for t in ts]
                names = [escape(r) for rs in part["roles"] for r in rs]
                coded = [np.frombuffer(x, "<u4") for x in encode(flat)]
                named = [np.frombuffer(x, "<u4") for x in encode(names)]
                rows, k = [], 0
                for conv_id, roles in zip(part["__conv"], part["roles"]):
                    own = [(r, names[k + i], named[k + i], coded[k + i]) for i, r in enumerate(roles)]
                    chars = sum(len(flat[k + i]) + (len("[INST][/INST]") if r == "user" else len("</s>") if r == "assistant"
                                                    else len("<s>[ROLE]</s>") + len(names[k + i])) for i, r in enumerate(roles))
                    k += len(roles)
                    sequence, mask = assemble(own, ids)
                    rows.append((conv_id, len(roles), sequence.astype("<u4").tobytes(), mask.astype(np.uint8).tobytes(), chars))
                yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "ids", "loss_mask", "formatted_chars"])

    return whole.mapInPandas(run, OUTPUT.format(kind="string")).withColumn("conv_id", F.col("conv_id").cast(kind)).withColumnRenamed("conv_id", conv)


def read_back(formatted: DataFrame, tokenizer: str, conv: str = "conv_id") -> DataFrame:
    """``conv_id, turns (role, text), loss_texts, formatted`` decoded from formatted conversations."""
    kind = formatted.schema[conv].dataType

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 100):
                part = pdf.iloc[at:at + 100]
                read = Read([np.frombuffer(x, "<u4") for x in part["ids"]], tokenizer)
                rows = [(c, [{"role": r, "text": t} for r, t in read.turns(i)], read.masked(i, np.frombuffer(mask, np.uint8).astype(bool)), read.rendered(i))
                        for i, (c, mask) in enumerate(zip(part["conv"], part["loss_mask"]))]
                yield pd.DataFrame(rows, columns=["conv", "turns", "loss_texts", "formatted"])

    return formatted.select(F.col(f"`{conv}`").cast("string").alias("conv"), "ids", "loss_mask") \
        .mapInPandas(run, "conv string, turns array<struct<role:string,text:string>>, loss_texts array<string>, formatted string") \
        .withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv)
