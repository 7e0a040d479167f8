"""The corpus operators against plain versions: personal data, language models, packing, top-k, sketches, hot keys, plans."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphspark.llm import common, decontam, langid, lines, minhash, packing, pii, suffix, tokens, topk, warc


def luhn(digits):
    worth = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))]
    return sum(worth) % 10 == 0


def plain_base(text):
    """Base spans by the expressions as they are given, one kind after another."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_personal_data_of_whole_texts(spark, monkeypatch):
    rng = random.Random(8)
    parts = ["a.b@c.de", "@", "x@y", "x@y.z.", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111110", "+1 (309) 555-7741", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é", "\U0001f600", "\n", " ", "word", "-", ".", "007", "a@b.c@d.e", "_%+-@-.-"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", ", "]) for _ in range(rng.randint(0, 14))) for _ in range(250)]
    texts += [None, "", "x" * 200_000 + " me@long.example " + "9" * 5_000, texts[0], texts[0]]
    rows = [(k if k % 9 else None, t, "clash") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)
    monkeypatch.setattr(pii, "read", lambda spark, sf_dir, table: docs)
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.op1_pii(spark, "").collect())
    want = Counter()
    for k, t, _ in rows:
        spans = plain_base(t or "")
        n = Counter(s[0] for s in spans)
        want[k, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{a}:{b}:{c}" for a, b, c in spans).encode()).hexdigest()] += 1
    assert got == want


def plain_entropies(samples, texts):
    """Interpolated Kneser-Ney by its definition: dictionaries of counts, recursion down to a uniform distribution."""
    order, pad = langid.ORDER, " " * (langid.ORDER - 1)
    counts = {}
    for x, own in samples.items():
        c = {order: Counter(p[i - order + 1 : i + 1] for t in own for p in [pad + langid.prepare(t)] for i in range(order - 1, len(p)))}
        for n in range(order - 1, 0, -1):
            c[n] = Counter(g[1:] for g in c[n + 1])
        counts[x] = c
    alphabet = len({g for c in counts.values() for g in c[1]}) + 1
    out = []
    for t in texts:
        row = []
        for c in counts.values():
            discount, total, kinds = {}, {}, {}
            for n in range(1, order + 1):
                ones, twos = sum(v == 1 for v in c[n].values()), sum(v == 2 for v in c[n].values())
                discount[n] = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + 2 * twos else 0.5))
                total[n], kinds[n] = Counter(), Counter()
                for g, v in c[n].items():
                    total[n][g[:-1]] += v
                    kinds[n][g[:-1]] += 1

            def p(g, c=c, discount=discount, total=total, kinds=kinds):
                n = len(g)
                below = p(g[1:]) if n > 1 else 1 / alphabet
                whole = total[n][g[:-1]]
                if not whole:
                    return below
                return max(c[n][g] - discount[n], 0) / whole + discount[n] * kinds[n][g[:-1]] / whole * below

            padded = pad + langid.prepare(t)
            row.append(-sum(math.log(p(padded[i - order + 1 : i + 1])) for i in range(order - 1, len(padded))) / (len(padded) - order + 1))
        out.append(row)
    return np.asarray(out)


def test_language_models_by_definition():
    rng = random.Random(2)
    made = {x: ["".join(rng.choice(a) for _ in range(rng.randint(1, 6))) for _ in range(30)] for x, a in {"aa": "abcde", "bb": "cdefgé", "cc": "xyz "}.items()}
    samples = {x: [" ".join(rng.choice(w) for _ in range(25)) for _ in range(6)] for x, w in made.items()}
    texts = [" ".join(rng.choice(w) for _ in range(12)) for w in made.values() for _ in range(3)] + ["q", "ab", "中文 unseen", "a" * 50]
    got = langid._fit({x: [langid.prepare(t) for t in own] for x, own in samples.items()}).entropies([langid.prepare(t) for t in texts])
    assert np.allclose(got, plain_entropies(samples, texts), atol=2e-4)


def test_language_of_repeats_and_long_texts(spark):
    rows = [(k, "the house and the river " * 3, "en") for k in range(30)] + [(100 + k, "la maison et le fleuve " * 3, "fr") for k in range(30)]
    model = langid.train(langid.sample_labelled(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    long = "la maison et le fleuve " * 20_000
    asked = spark.createDataFrame([(1, long, 0.5), (1, long, 0.5), (2, "the river", None), (None, "", 1.0)], "doc_id long, text string, score double")
    got = Counter((r.doc_id, r.lang_pred, r.score >= 0.5) for r in langid.identify(asked, model).collect())
    assert got == Counter({(1, "fr", True): 2, (2, "en", True): 1, (None, "und", False): 1})
    assert langid.identify(asked.limit(0), model).count() == 0


HARD = {
    "most just over a third": lambda r: Counter(r.randint(600, 1101, 4000).tolist()),
    "wide": lambda r: Counter(r.randint(500, 2001, 4000).tolist()),
    "steps": lambda r: Counter((r.randint(10, 51, 4000) * 20).tolist()),
    "few": lambda r: Counter({700: 3, 900: 5, 1200: 2, 30: 9, 2048: 4}),
    "one length": lambda r: Counter({1025: 7}),
    "nothing": lambda r: Counter(),
}


@pytest.mark.parametrize("name", HARD)
def test_packing_against_its_bound(name):
    histogram = HARD[name](np.random.RandomState(4))
    plan, bound = packing.solve(dict(histogram), 2048)
    held = Counter()
    for items, times in plan:
        assert sum(items) <= 2048 and times > 0
        for x in items:
            held[x] += times
    used, plain = sum(t for _, t in plan), sum(packing.best_fit(dict(histogram), 2048).values())
    assert held == histogram and bound - 1e-6 <= used <= plain
    assert bound >= sum(x * n for x, n in histogram.items()) / 2048 - 1e-6


def test_packed_ids(spark):
    tok = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)] + ["<|endoftext|>", "<|startoftext|>", "it's", "中"]
    say = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", " \t", ". "]) for _ in range(n))
    rows = [(k, say(rng.randint(0, 40)), 7) for k in range(40)] + [(50, say(4_000), 7), (None, None, 7), (51, "", 7), (3, say(2_000), 7), (60, say(5), 7), (60, say(5), 7)]
    rows.append(rows[0])
    library = Tokenizer.from_file(tok.path("word_bpe_49k.json"))
    want = Counter()
    for d, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            want[d, p, at, len(own), zlib.crc32(np.asarray(own, "<u4").tobytes())] += 1
    packed = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(4), tok.path("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    by = defaultdict(list)
    for r in packed:
        assert zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        assert [o for o, _ in sorted(places)] == [0, *np.cumsum([n for _, n in sorted(places)])[:-1].tolist()] and sum(n for _, n in places) <= 2048


def test_counts_of_long_and_special_texts(spark, monkeypatch):
    tok = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "MEMO_BYTES", 3_000)
    rng = random.Random(1)
    words = ["<|endoftext|>", "don't", "a" * 700, "naïve", "中文", "  ", "x1y2", "3.14", "\r\n", " "] + ["".join(rng.choice("etaoin") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["spaceless" * 70_000, "many words " * 60_000 + "end", None, ""]
    library = Tokenizer.from_file(tok.path("byte_bpe_50k.json"))
    memo = tokens.LengthMemo(tok.path("byte_bpe_50k.json"))
    assert [n for run in tokens.grouped(texts) for n in memo.counts(run)] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    clash = spark.createDataFrame([(1, "some words", "a", True)], "doc_id long, text string, n_tokens string, over_limit boolean")
    assert tokens.count_tokens(clash, tok.path("byte_bpe_50k.json"), limit=1).select("n_tokens", "n_bytes", "over_limit").first()[:] == (2, 10, True)


@pytest.mark.parametrize("block", [4096, 2])
def test_top_k_of_ties_and_widths(spark, block):
    rng = np.random.RandomState(3)
    vectors = {k: rng.randint(-2, 3, 4 + (k % 3 == 0)).tolist() for k in range(120)} | {200: [], 201: [1, 1, 1, 1]}
    rows = [(k, [x / 1024 for x in v], "x") for k, v in vectors.items()] + [(201, [1 / 1024] * 4, "x"), (None, [1.0] * 4, "x")]
    table = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4))
    queries = [0, 7, 100, 201]
    got = Counter(tuple(r) for r in topk.top_k(table.where(F.col("vec_id").isin(queries)), table, 5, block).collect())
    want = Counter()
    for q in queries:
        found = [(-int(np.dot(vectors[q], v)), k) for k, v in [*vectors.items(), (201, vectors[201])] if k != q and len(v) == len(vectors[q]) and v]
        want.update((q, i + 1, k, -s) for i, (s, k) in enumerate(sorted(found)[:5]))
    assert got == want
    assert topk.top_k(table.limit(0), table).count() == topk.top_k(table.where("vec_id = 7"), table.limit(0)).count() == 0


def test_sketches_of_large_sets(spark):
    """Texts of 65 to 2,000 shingles with similarities on both sides of the threshold, against all pairs on full sets."""
    rng = random.Random(12)
    rows = []
    for g in range(24):
        n = int(65 * (2000 / 65) ** (g / 23))
        base = [f"g{g}w{rng.randint(0, 10**6)}" for _ in range(n)]
        for k in range(4):
            # A changed word takes three shingles: shares of change so that similarities lie around the threshold.
            share = [0, 0.02, 0.03, 0.045][k]
            rows.append((100 * g + k, " ".join(w if rng.random() >= share else f"x{rng.randint(0, 10**6)}" for w in base)))
    full = {d: {tuple(w) for t in [x.split()] for w in zip(t, t[1:], t[2:], strict=False)} for d, x in rows}
    least = {d: d for d in full}
    for _ in range(4):
        for a in full:
            for b in full:
                if a // 100 == b // 100 and 100 * len(full[a] & full[b]) >= 85 * len(full[a] | full[b]):
                    least[a] = least[b] = min(least[a], least[b])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {d: (len(s), least[d], least[d] == d) for d, s in full.items()}
    assert 10 < sum(d != least[d] for d in full) < 60


def test_hot_lines_passages_and_pages(spark, monkeypatch, tmp_path):
    """One line, passage and page in every row: keys are hot, results whole."""
    monkeypatch.setattr(common, "HOT_LEAST", 5)
    passage = "\n".join(f"this line is line number {k} of every text" for k in range(4))
    rows = [(k, f"own line of {k}\n{passage}\nlast of {k}") for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.text) for r in lines.dedup_lines(docs).collect()}
    assert got == {k: (6, 0, 0, t) if k == 0 else (6, 4, 1, f"own line of {k}\nlast of {k}") for k, t in rows}
    removed = {r.doc_id: r.n_removed for r in suffix.remove_repeats(docs).collect()}
    shared = f"\n{passage}\nlast of "
    assert removed[0] == 0 and all(removed[k] >= len(shared) for k in range(1, 150))
    assert {r.component_id for r in minhash.near_duplicates(docs.withColumn("text", F.lit(passage * 3)), 3, 85).collect()} == {0}
    near = docs.withColumn("text", F.concat(F.lit(" ".join(f"w{k}" for k in range(90))), F.lit(" "), F.col("doc_id").cast("string")))
    assert Counter(r.component_id for r in minhash.near_duplicates(near, 3, 85).collect()) == {0: 150}
    pages = spark.createDataFrame([(k, "u", "x" * 200 if k % 3 else f"{k}") for k in range(120)] + [(None, None, None)], "page_id long, url string, html string").repartition(4)
    found = {r.page_id: (r.record_type, r.refers_to) for r in warc.resolve_revisits(pages).collect()}
    assert found == {k: ("revisit", 1) if k % 3 and k > 1 else ("response", None) for k in range(120)} | {None: ("response", None)}
    warc.write_warc(warc.resolve_revisits(pages.limit(0)), f"file://{tmp_path}/none")
    assert warc.read_warc(spark, f"file://{tmp_path}/none").count() == 0


def test_archives_of_others(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\n\xff\xfebytes"
    record = lambda kind, body, *more: b"WARC/1.0\r\n" + b"".join(x + b"\r\n" for x in (b"WARC-Type: " + kind, *more, b"Content-Length: %d" % len(body))) + b"\r\n" + body + b"\r\n\r\n"
    (tmp_path / "o.warc").write_bytes(record(b"warcinfo", b"software: x") + record(b"response", block, b"WARC-Target-URI:http://a/") + record(b"revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", b"WARC-Payload-Digest: sha1:ABC"))
    got = [tuple(r) for r in warc.read_warc(spark, f"file://{tmp_path}").select("page_id", "url", "payload_bytes", "record_type", "html").collect()]
    assert got == [(None, None, 11, "warcinfo", None), (None, "http://a/", 7, "response", "��bytes"), (None, None, None, "revisit", None)]


def test_decontamination_of_many_hits(spark):
    long = [f"t{k}" for k in range(3_000)]
    bench = spark.createDataFrame([(1, " ".join(long[100:2_000])), (2, " ".join(long[1_995:2_020])), (3, "Short Item"), (4, "item two")], "item_id long, text string")
    docs = spark.createDataFrame([(1, ", ".join(long)), (2, "short item two; SHORT ITEM"), (3, "a short item\nb")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench).collect()}
    assert got == {1: ", ".join(long[:100]) + ", " + ", " + ", ".join(long[2_020:]), 3: "a \nb"}


def test_stages_use_python_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name in ("language", "lines"):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, "/root/testdata/sf0.001")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, name


def test_pipeline_on_nulls_and_repeats(spark, tmp_path):
    """Null and repeated ids, empty texts and copies through all stages; each keeps what it should."""
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'en' AND length(text) > 400").limit(40)
    rows = base.collect()
    extra = [(None, rows[0].text, "en"), (rows[1].doc_id, rows[2].text, None), (rows[3].doc_id, rows[3].text, "en"), (900_001, None, None), (900_002, "", "en"), (900_003, "12 34", None)]
    more = spark.createDataFrame([(d, t, x, "made", 0) for d, t, x in extra], base.schema)
    docs, sf = base.unionByName(more), "/root/testdata/sf0.001"
    texts = {r.text for r in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        if name == "language":
            kept = {r.doc_id for r in docs.collect()}
            assert not {900_001, 900_002, 900_003} & kept and len(kept & {r.doc_id for r in rows}) >= 36
    left = [r.text for r in docs.collect()]
    assert docs.columns == base.columns and len(left) == len(set(left)) and len(left) <= len(texts)
    packed = corpus_pipeline.packing(spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.packing(spark, docs.limit(0), sf).count() == 0
