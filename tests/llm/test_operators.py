"""The corpus operators against plain versions on small tables, with nulls, empty texts, repeats and clashing names."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphspark.llm import decontam, langid, lines, minhash, packing, pii, suffix, tokens, topk, warc

UP = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    sentence = lambda n=9: " ".join(word() for _ in range(n))
    passage = "\n".join(sentence() for _ in range(5))
    rows = [(k, "\n".join([sentence() for _ in range(rng.randint(1, 5))] + ([passage] if k % 4 == 0 else [])), "en") for k in range(40)]
    rows += [(100, rows[0][1], None), (101, rows[1][1] + " end", "fr"), (102, None, "fr"), (103, "", "en"), (None, passage, "en"), (104, "\n\n \n", "en"), (105, "ab " * 3000, "en"), (106, passage + "\n" + passage, "en")]
    rows.append(rows[40])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n_lines", F.lit("clash")).repartition(3), rows


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def sets(text, width):
    x = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    return {tuple(x[i : i + width]) for i in range(len(x) - width + 1)} if len(x) >= width else {tuple(x)} if x else set()


def plain_components(rows, width, percent):
    found = [(d, sets(t, width)) for d, t, *_ in rows]
    above = list(range(len(found)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, (_, a) in enumerate(found):
        for j in range(i):
            b = found[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                above[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(found):
        k = top(i)
        least[k] = d if k not in least else min(x for x in (least[k], d) if x is not None) if (d is not None or least[k] is not None) else None
    return Counter((d, len(s), least[top(i)]) for i, (d, s) in enumerate(found))


@pytest.mark.parametrize("dense", [8, 0])
def test_near_duplicates(spark, corpus, empty, monkeypatch, dense):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = corpus[1] + [(1000 + k, " ".join(w if rng.random() > rng.choice([0.005, 0.03]) else f"x{rng.randint(0, 9)}" for w in base), "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(minhash, "DENSE", dense)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, 3, 85).collect())
    assert got == plain_components(rows, 3, 85)
    if dense:
        assert minhash.near_duplicates(empty).count() == 0
        kept = minhash.keep_one(corpus[0])
        assert kept.columns == corpus[0].columns and kept.where("doc_id = 100").count() == 0 and kept.where("doc_id IN (102, 103, 104)").count() == 3


def test_keep_one_of_shared_ids(spark):
    rng = random.Random(4)
    say = lambda: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(40))
    a, b, c, d, e, f, g = (say() for _ in range(7))
    # Copies with a null and a shared id beside clean texts of these ids, a repeated row, and repeated rows without words.
    rows = [(1, a), (None, a + " end"), (None, b), (None, c), (2, d), (3, d), (3, e), (4, f), (4, f), (4, g), (5, None), (5, None), (None, ""), (None, "")]
    got = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(map(tuple, got.collect())) == Counter([(1, a), (None, b), (None, c), (2, d), (3, e), (4, f), (4, g), (5, None), (5, None), (None, ""), (None, "")])
    same = minhash.keep_one(spark.createDataFrame([(7, a), (7, a + " end"), (None, b), (None, b)], "doc_id long, text string")).collect()
    assert sorted(r.doc_id or 0 for r in same) == [0, 7]


def plain_repeats(rows, length):
    seen, out = set(), []
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        raw = (rows[k][1] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            gone[p : p + length] = b"\1" * length if s in seen else gone[p : p + length]
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((rows[k][0], len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("block", [2_000_000, 100])
def test_suffix_dedup(corpus, empty, monkeypatch, block):
    monkeypatch.setattr(suffix, "BLOCK", block)
    got = Counter(tuple(r)[:5] for r in suffix.remove_repeats(corpus[0]).collect())
    assert got == plain_repeats(corpus[1], 100)
    if block > 100:
        assert suffix.remove_repeats(empty).count() == 0


def test_borders_are_common_prefixes():
    rng = np.random.RandomState(1)
    codes = np.concatenate([rng.randint(97, 99, 200), [255]]).astype(np.uint8)
    order = suffix.sorted_rotations(codes, 8)
    known = suffix.borders(codes, order, 8)
    turned = [bytes(np.roll(codes, -k))[:8] for k in order.tolist()]
    assert turned == sorted(turned)
    assert known[1:-1].tolist() == [a != b for a, b in zip(turned[:-1], turned[1:], strict=True)]


def test_line_dedup(corpus, empty):
    seen, want = set(), Counter()
    once = {(d, t): None for d, t, _ in corpus[1]}
    for d, t in sorted(once, key=lambda x: (x[0] is None, x[0] or 0)):
        kept = [x for x in (t or "").split("\n") if x.strip(lines.MARGIN)]
        gone = set()
        for k in range(len(kept) - 2):
            w = tuple(kept[k : k + 3])
            gone |= {k, k + 1, k + 2} if w in seen else set()
            seen.add(w)
        once[d, t] = (d, len(kept), len(gone))
    for d, t, _ in corpus[1]:
        want[once[d, t]] += 1
    out = lines.dedup_lines(corpus[0])
    assert Counter((r.doc_id, r.n_lines, r.n_removed) for r in out.collect()) == want
    assert lines.dedup_lines(empty).count() == 0


def test_line_dedup_of_long_lines(spark):
    rng = random.Random(9)
    say = lambda n: " ".join(f"w{rng.randint(0, 999)}" for _ in range(n))
    one, two, short = say(60), [say(30), say(25)], say(20)
    rows = [(1, one), (2, f"{say(5)}\n {one}\t"), (3, "\n".join([say(8), *two])), (4, "\n\n".join([*two, say(9)])), (5, one), (6, short), (7, short), (8, "\n".join([short, say(10), say(10)])), (9, None), (None, one), (10, "\n".join([say(50), one, one]))]
    seen, want = set(), {}
    for d, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        kept, gone = [x.strip(lines.MARGIN) for x in (t or "").split("\n") if x.strip(lines.MARGIN)], set()
        for k in range(len(kept)):
            for n in (1, 2, 3):
                w = tuple(kept[k : k + n])
                if len(w) == n and (n == 3 or len(" ".join(w).split()) >= 50):
                    gone |= set(range(k, k + n)) if w in seen else set()
                    seen.add(w)
        want[d] = (len(kept), len(gone))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.dedup_lines(docs, words=50).collect()}
    assert got == want and want[2] == (2, 1) and want[4] == (3, 2) and want[5] == want[None] == (1, 1) and want[10] == (3, 2)
    assert {r.doc_id for r in corpus_pipeline.lines(spark, docs, "").collect()} == {1, 2, 3, 4, 6, 7, 8, 9, 10}
    assert lines.dedup_lines(docs).where("n_removed > 0").count() == 0


def test_decontamination(spark, corpus, empty):
    long = " ".join(f"t{k}" for k in range(14))
    bench = spark.createDataFrame([(1, long), (2, "Short Item"), (3, None), (4, "..."), (None, "ab ab")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before, {long.upper()}! after", "x"), (2, "a short item here", "x"), (3, None, "x"), (4, "", "x"), (5, long, "x"), (5, long, "x"), (6, "clean text", "x")], "doc_id long, text string, items string")
    got = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench).collect()}
    assert got == {1: "before, ! after", 2: "a  here", 3: None, 4: "", 6: "clean text"}
    assert decontam.find_hits(empty, bench).count() == 0 and decontam.decontaminate(docs, bench.limit(0)).count() == 7


def test_decontamination_keeps_repeated_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(k, f"short item {k}") for k in range(9)], "item_id long, text string")
    rows = [(1, "a short item 1 here"), (1, "a short item 1 here"), (1, "other text"), (2, None), (2, None), (None, "Short item 2, short item 3"), (None, "Short item 2, short item 3"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter([(1, 5, 3)] * 2 + [(1, 2, 0)] + [(2, 0, 0)] * 2 + [(None, 6, 6)] * 2 + [(3, 0, 0)])
    assert decontam.find_hits(docs, bench, block=2).agg(F.sum("n_rows")).first()[0] == len(rows)
    monkeypatch.setattr(decontam, "read", lambda spark, sf_dir, table: {"documents": docs, "benchmark": bench}[table])
    assert Counter((r.doc_id, r.n_words, r.n_hit) for r in decontam.op4_decontamination(spark, "").collect()) == want


def test_token_counts_and_packing(corpus, empty):
    tok = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tok.path("byte_bpe_50k.json"))
    got = Counter((r.doc_id, r.n_tokens) for r in tokens.count_tokens(corpus[0], tok.path("byte_bpe_50k.json")).collect())
    assert got == Counter((d, len(t.encode(x or "", add_special_tokens=False).ids)) for d, x, _ in corpus[1])
    packed = packing.pack_documents(corpus[0], tok.path("word_bpe_49k.json"), 64).collect()
    w = Tokenizer.from_file(tok.path("word_bpe_49k.json"))
    assert sum(r.length for r in packed) == sum(len(w.encode(x or "", add_special_tokens=False).ids) + 1 for _, x, _ in corpus[1])
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.pack_documents(empty, tok.path("word_bpe_49k.json")).count() == 0


def test_language(spark, empty):
    rows = [(k, "the house and the river " * 3, "en") for k in range(30)] + [(100 + k, "la maison et le fleuve " * 3, "fr") for k in range(30)] + [(500, None, None), (501, "123 !!", None), (502, "the river house", None), (503, "qzx" * 400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in langid.identify(docs, langid.train(langid.sample_labelled(docs))).collect()}
    assert out[500].lang_pred == out[501].lang_pred == "und" and out[502].lang_pred == "en" and out[103].lang_pred == "fr" and not out[3].rejected and out[503].rejected
    assert langid.identify(docs, langid.train(langid.sample_labelled(empty))).where("lang_pred = 'und' AND rejected").count() == len(rows)


def test_language_with_few_rows():
    rng = random.Random(11)
    made = {x: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(400)] for x, letters in {"aa": "abcdefgh", "bb": "ijklmnopq"}.items()}
    texts = {x: [" ".join(rng.choice(w) for _ in range(60)) for _ in range(160)] for x, w in made.items()}
    for n in (1, 4, 7, 12):
        got = langid.train({"aa": texts["aa"][:120], "bb": texts["bb"][:n]}).score(texts["bb"][60:] + ["\u4e00\u4e8c\u4e09 " * 50])
        assert (got.language[:-1] == "bb").all() and got.rejected[:-1].sum() <= 5
        assert n < langid.LEAST or got.rejected[len(got) - 1]


def test_language_sample_of_long_rows(spark):
    rows = [(k, f"{k} " + "é" * (50_000 if k % 2 else 100), "fr") for k in range(40)] + [(100 + k, "long " * 1000 + str(k), "en") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample_labelled(docs, most_bytes=20_000, total=20_000)
    folded = {r[0] for r in docs.where(langid.fold(F.col("doc_id")) != 1).select("doc_id").collect()}
    assert sorted(int(t.split()[0]) for t in got["fr"]) == sorted(k for k in folded if k < 100)
    assert len(got["en"]) == len([k for k in folded if k >= 100]) and all(sum(len(t.encode()) for t in x) <= 20_000 for x in got.values())
    assert all(t.count("é") == 100 for t in got["fr"] if int(t.split()[0]) % 2 == 0)


def test_pii(spark, empty):
    docs = spark.createDataFrame([(1, "mail a.b@c.de, ip 10.0.0.1 or 300.1.1.1", "x"), (2, None, "x"), (3, "card 4111 1111 1111 1111 call +1 (555) 010-9999", "x"), (None, "x@y.zz", "x")], "doc_id long, text string, base string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find_pii(docs).collect()}
    assert got == {1: [("email", 5, 13), ("ip", 18, 26)], 2: [], 3: [("card", 5, 24), ("phone", 30, 47)], None: [("email", 0, 6)]}
    assert pii.find_pii(empty).count() == 0


def test_pii_of_seeded_contexts(spark):
    def luhn(digits):
        worth = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))]
        return sum(worth) % 10 == 0

    cards = [x for k in range(400) if luhn(x := f"4111111111{k:06d}")][:30]
    spaced = [" ".join(x[i : i + 4] for i in range(0, 16, 4)) for x in cards]
    texts = [f"please call +1 (309) 555-{k:04d} today, my card {c} is new, mail u{k}@x.org soon" for k, c in enumerate(spaced)]
    unseen = {100: ("please call ", "(309) 555-7741", " today", "phone"), 101: ("my card ", "3782 822463 10005", " is new", "card"), 102: ("my card ", "3782-822463-10005", " is new", "card"), 103: ("mail ", "a" * 70 + "@intranet", " soon", "email")}
    rows = [*enumerate(texts), *((k, a + b + c) for k, (a, b, c, _) in unseen.items()), (200, "pages 12 14 16 18 20 of 30")]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (a, b, _, kind) in unseen.items():
        assert not got[k].base and (kind, len(a), len(a + b)) in [(s.kind, s.start, s.end) for s in got[k].spans]
    assert all(len(got[k].base) == len(got[k].spans) == 3 for k in range(30)) and not got[200].spans


def test_top_k(spark):
    rng = np.random.RandomState(0)
    v = {k: rng.randn(8).astype(np.float32).tolist() for k in range(300)}
    rows = [*v.items(), (400, None), (401, [None] * 8), (402, [float("nan")] * 8)]
    table = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = [tuple(r) for r in topk.top_k(table.where("vec_id % 100 = 0"), table).orderBy("query_id", "rank").collect()]
    x = {k: np.floor(np.asarray(e, np.float64) * 1024).astype(int) for k, e in v.items()}
    want = [(q, k + 1, i, s) for q in (0, 100, 200) for k, (s, i) in enumerate(sorted(((int(x[q] @ x[c]), c) for c in x if c != q), key=lambda y: (-y[0], y[1]))[:10])]
    assert got == want


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_warc_round_trip(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    page = "<p>" + "x\r\n\r\n" * 40
    rows = [(1, "http://a/\n1", page), (2, "http://a/2", page), (3, None, "short"), (4, "u", "short"), (5, "u", None)]
    resolved = warc.resolve_revisits(spark.createDataFrame(rows, "page_id long, url string, html string"))
    warc.write_warc(resolved, f"file://{tmp_path}/w")
    got = {r.page_id: r for r in warc.read_warc(spark, f"file://{tmp_path}/w").collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("response", None), 5: ("response", None)}
    assert got[1].html == page and got[2].payload_digest == hashlib.sha256(page.encode()).hexdigest()
