"""Awkward rows for the operators on notes, chats, pages and labels, and brute force where SQL has no form."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stairfare.llm import contamination, dialogues, overlap_join, personal_data, quality_votes, toxicity

BYTES = public_tokenizers.path("byte_bpe_50k.json")
NOTE = "write ali@example.org or +90 (212) 555-0101, card 4539 1488 0343 6467, host 10.0.0.255, token = \"%s\"" % hashlib.sha1(b"x").hexdigest()
ROWS = [(1, NOTE), (2, NOTE), (2, NOTE), (None, "no 10.0.0.256 here"), (3, None), (4, ""), (5, "a@b.cd " * 5_000), (6, "😀 +123456789 x@y"), (7, "1-2 " * 3_000)]


def table(spark, rows):
    """Notes beside columns named like the operators' own helpers."""
    return spark.createDataFrame([(k, t, i, "own", [i], "given") for i, (k, t) in enumerate(rows)],
                                 "package_key long, description string, __mark long, spans string, __text array<int>, __row string")


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    """The four base kinds by plain patterns, leftmost and non-overlapping per kind."""
    kinds = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
             "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)}
    return [(k, m.start(), m.end()) for k, (pattern, good) in kinds.items() for m in re.finditer(pattern, text or "") if good(m.group())]


def test_base_spans_equal_plain_patterns(spark):
    rng = np.random.default_rng(1)
    parts = ["a.b@c.de", "@", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4539 1488 0343 6467", "4539148803436467", "4539-1488-0343-6468", "+49 30 1234567", "+1", "(0)", " ", "-", ".", "é", "9" * 20]
    rows = ROWS + [(100 + i, "".join(rng.choice(parts, 12))) for i in range(300)]
    got = Counter((r.package_key, tuple((s.kind, s.start, s.end) for s in r.base_spans), r.n_email, r.n_ip, r.n_card, r.n_phone)
                  for r in personal_data.find(table(spark, rows)).collect())
    want = Counter((k, tuple(found := base_spans(t)), *(sum(s[0] == kind for s in found) for kind in ("email", "ip", "card", "phone"))) for k, t in rows)
    assert got == want
    assert personal_data.find(table(spark, [])).count() == 0


def test_masking_keeps_every_other_column_and_hides_secrets(spark):
    df = table(spark, ROWS)
    out = personal_data.masked(df)
    assert out.schema == df.schema
    got = {r["__mark"]: r for r in out.collect()}
    assert len(got) == len(ROWS) and all(r.spans == "own" and r["__text"] == [i] and r["__row"] == "given" for i, r in got.items())
    assert got[0].description == got[2].description == 'write [EMAIL] or [PHONE], card [CARD], host [IP], token = "[SECRET]"'
    assert got[4].description is None and got[3].description == ROWS[3][1]
    assert personal_data.masked(table(spark, [])).count() == 0


def test_secrets_need_a_shape_and_a_word_close_by(spark):
    sha, coded = hashlib.sha1(b"y").hexdigest(), base64.b64encode(hashlib.md5(b"z").digest()).decode()
    notes = [f"api_key: {sha}", f"commit {sha}", "token = aaaaaaaaaaaaaaaaaaaaaaaa11", "password reset-your-own-password-now", f"Bearer {coded}", f"the key is {sha}{sha}x" * 2]
    got = {r.package_key: [notes[r.package_key][s.start:s.end] for s in r.spans if s.kind == "secret"] for r in personal_data.find(table(spark, list(enumerate(notes)))).collect()}
    assert got == {0: [sha], 1: [], 2: [], 3: [], 4: [coded], 5: [sha + sha + "xthe", sha + sha + "x"]}


def test_tables_with_columns_named_like_helpers_come_back_whole(spark):
    rows = [(1, "seven wise men look on"), (2, "Cabin bag " * 40), (3, None), (None, "seven wise men look on")]
    df, q = table(spark, rows), spark.createDataFrame([(9, "Seven wise men")], "item_id long, text string")
    kept = contamination.drop_contaminated(df, q)
    assert kept.schema == df.schema and sorted(r["__mark"] for r in kept.collect()) == [1, 2]
    cut = contamination.cut_spans(df, q)
    assert cut.schema == df.schema and {r["__mark"]: r.description for r in cut.collect()} == {0: "   look on", 1: rows[1][1], 2: None, 3: "   look on"}
    one = overlap_join.keep_one(table(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (None, "x")]))
    assert one.schema == df.schema and sorted(r["__mark"] for r in one.collect()) == [0, 2]
    good = quality_votes.keep_good(df)
    assert good.schema == df.schema


def test_windows_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    text = "ein " * 5 + "the Quick brown fox jumps over a lazy dog while seven wise men look on " + "zwei " * 30
    rows = [(1, text), (2, "Seven, wise!"), (3, None), (4, ""), (None, text), (2, "Seven, wise!"), (5, text * 40)]
    q = spark.createDataFrame([(10, "The quick brown fox jumps over a lazy dog while seven wise men look on"), (11, "seven wise"), (12, None)], "item_id long, text string")
    found = lambda: Counter((r.package_key, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in contamination.overlap(table(spark, rows), q).collect())
    want = found()
    monkeypatch.setattr(contamination, "BROADCAST_WINDOWS", 0)
    assert found() == want and want[(2, 2, 2, ("11",), True)] == 2


def brute_chat(turns):
    """Per conversation: turns in order, texts of assistants, and the rendered string by plain string work."""
    out = {}
    for conv in {c for c, *_ in turns}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in turns if c == conv), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
        shown = "".join(f"[INST]{dialogues.escape(x)}[/INST]" if r == "user" else f"{dialogues.escape(x)}</s>" if r == "assistant"
                        else f"<s>{dialogues.escape(r)}[ROLE]{dialogues.escape(x)}</s>" for _, r, x in own)
        out[conv] = ([(r, x) for _, r, x in own], [x for _, r, x in own if r == "assistant" and x], shown)
    return out


def test_chats_equal_plain_string_work(spark):
    rng = np.random.default_rng(2)
    words = ["</s>", "[INST]", "[/INST]", "<\\s>", "[\\\\ROLE]", "é😀", " ", "ok", "\n", "<s>", "\t"]
    turns = [(int(c), int(t), str(rng.choice(["user", "assistant", "system", "tool</s>"])), "".join(rng.choice(words, int(rng.integers(0, 9)))))
             for c in range(40) for t in range(int(rng.integers(1, 7)))]
    turns += [(50, 1, "user", "a"), (50, 1, "user", "a"), (50, 1, "assistant", "tie"), (50, None, "assistant", "first"), (51, 0, None, None), (None, 0, "assistant", "x"),
              (52, 0, "assistant", "long </s> " * 20_000)]
    df = spark.createDataFrame([(*t, "own") for t in turns], "conv_id long, turn long, role string, text string, ids string")
    formatted = dialogues.format_turns(df, BYTES)
    want = brute_chat(turns)
    back = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_texts, r.formatted) for r in dialogues.read_back(formatted, BYTES).collect()}
    assert back == want
    assert {r.conv_id: r.formatted_chars for r in formatted.collect()} == {c: len(w[2]) for c, w in want.items()}


def plain_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), dup, len(hit)


def test_quality_figures_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x y z " * 20_000), (4, "l\nl\n l\n\nl"), (4, "l\nl\n l\n\nl"), (5, " \t\n ")]
    rows += [(10 + i, " ".join(rng.choice(["a", "b#", "c\n", "é", "<|>", "d\x0b"], int(rng.integers(1, 80))))) for i in range(150)]
    got = Counter((r.package_key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_votes.judge(table(spark, rows)).collect())
    want = Counter((k, *(f := plain_figures(t)), f[0] < 50 or 100 * f[4] > 50 * f[0]) for k, t in rows)
    assert got == want


def test_toxicity_of_awkward_rows(spark):
    calm = [(i, f"Seat number {i} by the window with a meal and tea") for i in range(80)]
    rude = [(1000 + i, f"Seat number {i} you stupid worthless moron by the window") for i in range(80)]
    odd = [(None, "tea"), (5000, None), (5001, ""), (5002, "tea and a seat by the window " * 20_000), (1, calm[1][1]), (1, calm[1][1])]
    df = table(spark, calm + rude + odd)
    labels = spark.createDataFrame([(k, int(k >= 1000), "x") for k, _ in calm + rude] + [(None, 1, "x"), (2, None, "x")], "package_key long, toxic int, description string")
    model = toxicity.train(df, labels)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(calm + rude + odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert sum(r.package_key == 1 for r in got) == 3 and all(r.held_out for r in got if r.package_key is None)
    assert toxicity.score(table(spark, []), model).count() == 0
