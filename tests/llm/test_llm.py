"""Operators on package descriptions beside brute force, with the awkward rows every one must take."""

import json
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from stairfare.llm import (contamination, dialogues, overlap_join, packing, page_text, personal_data, quality_votes, records, repeats, token_files,
                           tokens, toxicity)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RULE = "Cabin bag of eight kilos is part of this fare and a checked bag may be added later for a fee at the airport or online. "
LONG = " ".join(f"Rule{i} allows change{i % 7} before departure{i % 11}." for i in range(4000))


def table(spark, rows):
    """Packages with a column whose name the operators use inside, and a null in every column."""
    return spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "package_key long, description string, n long")


AWKWARD = [(1, RULE * 3), (2, RULE * 3), (2, RULE * 3), (3, None), (4, ""), (None, RULE * 3 + "Extra."), (5, LONG), (6, " \n\t "), (7, "é" * 300)]


def test_package_and_note_texts(spark):
    brand = "raw_brand_name string, description string"
    df = spark.createDataFrame([("TK|IST|JFK|Summer", [("Economy", [("Light", "No bag"), ("Flex", None)])]), ("LH|FRA|JFK|Winter", None)],
                               f"unit_key string, cabins array<struct<cabin:string,brands:array<struct<{brand.replace(' string', ':string')}>>>>")
    assert sorted((r.package_key, r.season, r.description) for r in records.package_texts(df).collect()) == [
        ("TK|IST|JFK|Summer|Economy|0", "Summer", "No bag"), ("TK|IST|JFK|Summer|Economy|1", "Summer", None)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({65 + i: 97 + i for i in range(26)}))


def test_contamination_equals_brute_force(spark):
    text = "ein " * 5 + "the Quick brown fox jumps over a lazy dog while seven wise men look on " + "zwei " * 30
    questions = [(10, "The quick brown fox jumps over a lazy dog while seven wise men look on"), (11, "seven wise"), (12, None), (13, "")]
    q = spark.createDataFrame(questions, "item_id long, text string")
    rows = [(1, text), (2, "Seven, wise!"), (3, None), (4, ""), (None, text), (2, "Seven, wise!")]
    got = sorted(((r.package_key or 0), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in contamination.overlap(table(spark, rows), q).collect())
    want = []
    for k, t in rows:
        w, hit, items = words(t), set(), set()
        for i, qt in questions:
            qw = words(qt)
            n = min(13, len(qw))
            for s in range(len(w) - n + 1) if n else []:
                if any(w[s:s + n] == qw[a:a + n] for a in range(len(qw) - n + 1)):
                    hit |= set(range(s, s + n))
                    items.add(str(i))
        want.append((k or 0, len(w), len(hit), tuple(sorted(items)), bool(hit) and 20 * len(hit) >= len(w)))
    assert got == sorted(want)
    assert contamination.overlap(table(spark, rows[:0]), q).count() == 0
    kept = contamination.drop_contaminated(table(spark, rows), q)
    assert sorted(r.package_key for r in kept.collect()) == [3, 4] and kept.columns == ["package_key", "description", "n"]
    assert [r.description for r in contamination.cut_spans(table(spark, [(2, "So Seven, wise!")]), q).collect()] == ["So , !"]


def test_personal_data(spark):
    note = "ask ali.veli@example.co.uk or +90 (212) 555-0101, card 4539 1488 0343 6467, host 10.0.0.255 not 10.0.0.256, iban DE89370400440532013000"
    rows = [(1, note), (2, None), (3, "a" * 50_000), (4, "x@y x@y.z.w@q.r 😀 +12345678")]
    got = {r.package_key: r for r in personal_data.find(table(spark, rows)).collect()}
    assert [note[s.start:s.end] for s in got[1].spans] == ["ali.veli@example.co.uk", "10.0.0.255", "4539 1488 0343 6467", "+90 (212) 555-0101", "DE89370400440532013000"]
    assert (got[2].n_email, got[3].n_email, got[4].n_email, got[4].n_phone) == (0, 0, 1, 0)
    masked = {r.package_key: r.description for r in personal_data.masked(table(spark, rows)).collect()}
    assert masked[1].startswith("ask [EMAIL] or [PHONE], card [CARD], host [IP] not 10.0.0.256") and masked[2] is None and masked[3] == "a" * 50_000


def test_account_numbers_end_before_the_next_word(spark):
    be, es, de = "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00"
    notes = [f"IBAN {be} BIC GKCCBEBB", f"iban {es} EUR 20", f"iban {es} {be} {de}", f"iban BE12 {be}.", f"iban {be}, {de}x", f"iban {de} BIC", "iban " + "AB12 " * 4_000]
    want = [[be], [es], [es, be, de], [be], [be], [de], []]
    df = table(spark, list(enumerate(notes)))
    got = {r.package_key: [notes[r.package_key][s.start:s.end] for s in r.spans if s.kind == "iban"] for r in personal_data.find(df).collect()}
    assert [got[i] for i in range(len(notes) - 1)] == want[:-1]
    masked = {r.package_key: r.description for r in personal_data.masked(df).collect()}
    assert masked[0] == "IBAN [IBAN] BIC GKCCBEBB" and masked[2] == "iban [IBAN] [IBAN] [IBAN]"


def test_quality_votes(spark):
    good = [(i, " ".join(f"Word{j * (i + 3) % 97} is fine." for j in range(60))) for i in range(30)]
    bad = [(100 + i, " ".join(f"###{j * (i + 5) % 89}$$$ |" for j in range(60))) for i in range(5)]
    rows = good + bad + [(200, None), (201, ""), (202, "same same same same " * 40), (None, "few words")]
    got = {r.package_key: r for r in quality_votes.judge(table(spark, rows)).collect()}
    assert all(got[k].kept for k, _ in good) and not any(got[k].kept for k, _ in bad)
    assert got[200].base_failed and got[202].base_failed and got[202].n_repeat_words == 160 and not got[None].kept
    assert quality_votes.judge(table(spark, [])).count() == 0
    assert {r.package_key for r in quality_votes.keep_good(table(spark, rows)).collect()} == {k for k, _ in good}


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    keys = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    return sorted((k or -1, len(s), keys[r] or -1) for (k, _), s, r in zip(rows, sets, root))


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(AWKWARD)
    for g in range(12):
        base = rng.choice(vocabulary, 80).tolist()
        for c in range(6):
            w = list(base)
            for _ in range(c):
                w[int(rng.integers(80))] = f"new{rng.integers(1000)}"
            rows.append((100 + 10 * g + c, " ".join(w)))
    got = sorted((r.package_key or -1, r.n_shingles, r.component_key or -1) for r in overlap_join.link(table(spark, rows)).collect())
    assert got == brute_links(rows)
    assert overlap_join.link(table(spark, [])).count() == 0


def test_packing_is_exact(spark):
    rows = AWKWARD
    got = packing.pack(table(spark, rows), BYTES, window=64, open_windows=3).collect()
    ids = [tokens.encode_documents(BYTES, [t or ""], 1)[0] for _, t in rows]
    assert sum(r.length for r in got) == sum(map(len, ids))
    by = Counter()
    windows = {}
    for r in got:
        assert any(r.ids == x[r.start:r.start + r.length].tobytes() and r.doc_tokens == len(x) for (k, _), x in zip(rows, ids) if k == r.package_key)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by[r.sequence_id] += r.length
    for w, parts in windows.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert all(n == 64 or n & (n - 1) == 0 for n in by.values())
    assert packing.pack(table(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoding_by_words_equals_whole(path):
    texts = ["Cabin bag  included\n\n 8 kg", "", " \n", "it's\tTAB  x", "İstanbul–Zürich <|endoftext|> é́ 日本", LONG, "a\x1cb \x1c c", "  x"]
    whole = tokens.Encoder(path).tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.Encoder(path).encode(texts)] == [e.ids for e in whole]


def test_token_files_round_trip(spark, tmp_path):
    df = table(spark, AWKWARD)
    folder, dictionary, shards = token_files.write(df, WORDS, folder=str(tmp_path / "tok"), shards=3)
    got = token_files.read(spark, folder, dictionary, shards, kind="bigint").orderBy("start").collect()
    assert [r.package_key for r in got] == sorted((k for k, _ in AWKWARD), key=lambda k: -1 if k is None else k)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = Counter(zlib.crc32(tokens.encode_documents(WORDS, [t or ""], 1)[0].tobytes()) for _, t in AWKWARD)
    assert Counter(zlib.crc32(r.ids) for r in got) == want
    first = min(shards)
    assert token_files.read_text(folder, first, dictionary, 0)[-1] == 1
    with pytest.raises(ValueError):
        token_files.open_shard(folder, first, b"another")


def test_repeats_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    part = ["".join(rng.choice(list("abcdefgh é"), 260)) for _ in range(6)]
    rows = AWKWARD + [(50 + i, part[i % 6] + "".join(rng.choice(list("xyz "), 150)) + part[(i * 5 + 1) % 6]) for i in range(12)] + [(90, "a" * 900)]
    got = Counter((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(table(spark, rows)).collect())
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    want = Counter()
    for t in texts:
        spans = []
        for i in range(len(t) - 199):
            if count[t[i:i + 200]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 200
                else:
                    spans.append([i, i + 200])
        kept = b"".join(t[a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(t)]))
        want[(len(t), len(t) - len(kept), len(spans), kept)] += 1
    assert got == want
    assert repeats.remove_repeats(table(spark, [])).count() == 0


def test_repeats_of_a_large_seed_meet_in_no_one_task(monkeypatch):
    rng = np.random.default_rng(4)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    passage = word(260)
    texts = [word(130) + passage + word(130) for _ in range(4_500)] + [word(90) + passage + "." for _ in range(2)] + [passage * 2] * 2
    widest, held, buckets = [0], repeats._repeated_offsets, 4
    monkeypatch.setattr(repeats, "_repeated_offsets", lambda s, *a: widest.append(len(s)) or held(s, *a))

    def grouped(pdfs, keys, run):
        return pd.concat([run(part) for _, part in pd.concat(pdfs).groupby(keys)])

    df = pd.DataFrame({"__uid": range(len(texts)), "__text": texts})
    parts = [df.iloc[lo:lo + 700] for lo in range(0, len(df), 700)]
    seeds = grouped(repeats._send_seeds(buckets)(parts), "bucket", repeats._seen_twice(buckets))
    places = grouped([seeds], "bucket", repeats._places)
    rows = list(repeats._send_runs(buckets)([part.merge(places, left_on="__uid", right_on="uid") for part in parts]))
    keys = [c for c in ("kind", "bucket") if c in rows[0]]
    spans = grouped([grouped(rows, keys, repeats._covered(buckets))], "bucket", repeats._spans)
    got = {u: list(zip(np.frombuffer(s, "<i8").tolist(), np.frombuffer(e, "<i8").tolist())) for u, s, e in spans.itertuples(index=False)}

    counts = Counter(t[i:i + repeats.LENGTH] for t in texts for i in range(len(t) - repeats.LENGTH + 1))
    for u, t in enumerate(texts):
        want = []
        for i in range(len(t) - repeats.LENGTH + 1):
            if counts[t[i:i + repeats.LENGTH]] > 1:
                if want and i <= want[-1][1]:
                    want[-1] = want[-1][0], i + repeats.LENGTH
                else:
                    want.append((i, i + repeats.LENGTH))
        assert got.get(u, []) == want
    assert max(widest) < 4_500


def test_loser_tree_merges_and_knows_shared_lengths():
    rng = np.random.default_rng(3)
    runs = [sorted("".join(rng.choice(list("ab"), int(rng.integers(1, 9)))).encode() for _ in range(int(n))) for n in rng.integers(0, 30, 7)]
    out = list(repeats.LoserTree([repeats.front_coded(r) for r in runs]))
    assert [s for _, s, _ in out] == sorted(s for r in runs for s in r)
    assert all(k <= repeats.shared(a, b) for (_, a, _), (_, b, k) in zip(out, out[1:]))
    assert [k for (_, a, _), (_, b, k) in zip(out, out[1:])] == [repeats.shared(a, b) for (_, a, _), (_, b, _) in zip(out, out[1:])]


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "a </s>[INST] <\\s> b"), (1, 1, "assistant", "ok [/INST]</s>"), (1, 2, "system", None), (2, None, None, "x"), (None, 0, "assistant", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = dialogues.format_turns(df, BYTES)
    back = {r.conv_id: r for r in dialogues.read_back(formatted, BYTES).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r, t or "") for c, _, r, t in turns if c == 1]
    assert back[1].loss_texts == ["ok [/INST]</s>"] and "[INST]a <\\/s>[\\INST]" in back[1].formatted
    assert {r.conv_id: r.formatted_chars for r in formatted.collect()} == {c: len(b.formatted) for c, b in back.items()}
    assert dialogues.format_turns(df.limit(0), BYTES).count() == 0


def test_page_text(spark):
    body = "<p>" + "The lounge is open to all guests of this fare. " * 6 + "</p>"
    page = "<html><body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>Lounge &amp; bags</h1>%s<p>Tea  and\ncake.</p></article><footer>c</footer><script>a<b</script></body>" % body
    df = spark.createDataFrame([(i, "u", page) for i in range(20)] + [(98, "u", None), (99, None, "")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in page_text.extract(df, page_text.train(df)).collect()}
    assert got[3].split("\n")[0] == "Lounge & bags" and got[3].endswith("Tea and cake.") and "Home" not in got[3] and got[98] == got[99] == ""


def test_block_vector_reads_every_word():
    opening = " ".join(["The lounge is open"] * 6)
    one, other = (page_text.vectors([(("html", "body"), f"{opening} {rest}", 0.0)])[0] for rest in ("to all guests now", "buy one get two"))
    words = slice(page_text.PATH_DIM, page_text.PATH_DIM + page_text.WORD_DIM)
    assert not np.allclose(one[words], other[words]) and np.isclose(one[words].sum(), 1)


def test_toxicity(spark):
    calm = [(i, f"Seat number {i} by the window with a meal and tea") for i in range(120)]
    rude = [(1000 + i, f"Seat number {i} you stupid worthless moron by the window") for i in range(120)]
    df = table(spark, calm + rude + [(5000, None), (5001, "you stupidd morons")])
    labels = spark.createDataFrame([(k, int(k >= 1000)) for k, _ in calm + rude], "package_key long, toxic int")
    got = {r.package_key: r for r in toxicity.score(df, toxicity.train(df, labels)).collect()}
    assert sum(got[k].predicted == (k >= 1000) for k, _ in calm + rude if got[k].held_out) >= 0.95 * sum(got[k].held_out for k, _ in calm + rude)
    assert got[5000].predicted == 0 and 0 <= got[5000].score <= 1 and got[5001].score > got[5000].score
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())


def test_fitting_reads_long_texts_to_the_end():
    calm = [f"seat {w} by the window with a meal and tea " * 300 for w in ("one", "two", "three", "four") * 10]
    short = [f"seat {w} you stupid worthless moron" for w in ("one", "two", "three", "four") * 10]
    late = [t + "you stupid worthless moron" for t in calm]
    model = toxicity.fit(calm + short + late, np.repeat([0, 1, 1], len(calm)))
    assert toxicity.score_text(late[0], model) > 0.9 and toxicity.score_text(calm[0], model) < 0.1


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline
    docs = spark.createDataFrame([(i, " ".join(f"Word{j * (i + 3) % 97} is fine." for j in range(60)), "en", "s", 5) for i in range(6)] + [(9, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == docs.columns
    assert json.dumps(sorted(r.doc_id for r in df.collect())) == "[0, 1, 2, 3, 4, 5]"


def test_anchors_of_a_long_text_do_not_depend_on_its_stretches(monkeypatch):
    text = np.random.default_rng(5).integers(97, 100, 40_000, dtype=np.uint8).tobytes()
    _, places, _ = repeats.anchors([text])
    monkeypatch.setattr(repeats, "PASS_BYTES", 1_000)
    got = set()
    for parts, owner, offset in repeats._passes([b"", text, text[:250]]):
        doc, place, _ = repeats.anchors(parts)
        got |= {int(p) for p, i in zip(place + offset[doc], owner[doc]) if i == 1}
    assert got == set(places.tolist())


def test_memory_of_anchors_does_not_follow_the_text():
    import tracemalloc
    text = np.random.default_rng(6).integers(97, 123, 20_000_000, dtype=np.uint8).tobytes().decode()
    tracemalloc.start()
    rows = list(repeats._send_seeds(8)([pd.DataFrame({"__uid": [1], "__text": [text]})]))
    assert rows and tracemalloc.get_traced_memory()[1] < 150_000_000
    tracemalloc.stop()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoding_does_not_depend_on_the_passes(monkeypatch, path):
    texts = ["Cabin bag,  included.\n\n8 kg (free) " * 40, "", "été: ñandú's bag!" * 30, "tab\there  is one " * 30, "x" * 500]
    whole = tokens.Encoder(path).encode(texts)
    monkeypatch.setattr(tokens, "PASS_BYTES", 60)
    assert tokens.Encoder(path).encode(texts) == whole
    assert [np.frombuffer(x, "<u4").tolist() for x in whole] == [e.ids for e in tokens.Encoder(path).tokenizer.encode_batch(texts, add_special_tokens=False)]
