"""The ten operators against brute force, on sf0.001 and on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from creamery.llm import bpe, hyperplanes, line_frequency, line_windows, mixing, phrases, ppm, simhash, token_files, toxicity
from creamery.llm.common import table
from creamery.llm.components import connected_components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
COPY = " ".join(f"c{i}" for i in range(60))
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, LONG, "en", "b"),
    (5, COPY, "en", "b"), (6, "x y " + COPY + " z", "en", None), (7, COPY, "de", "b"), (8, COPY + " " + COPY, "de", "c"),
    (9, "a a a a a a a a a a a a", "fr", "c"), (10, "one line here\ntwo lines here\nthree\nfour\none line here\ntwo lines here\nthree", "en", "c"),
    (11, "zero\none line here\n\ntwo lines here\nthree\nfour", "en", "c"), (12, "<|endoftext|> Don't ÉCOLE  stop   12,345!? \U0001f600 \x00", "en", "a"),
    (None, COPY, "en", "a"), (13, "same", "en", "a"), (13, "same", "en", "a"), (14, "###$$$ | <> %", None, "z"),
]


@pytest.fixture(scope="module", params=["awkward", "empty", "sf"])
def docs(request, spark):
    if request.param == "sf":
        return table(spark, SF, "documents")
    rows = ROWS if request.param == "awkward" else []
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return d.withColumns({"n_chars": F.length("text").cast("long"), "key": F.lit(1), "h": F.lit("x"), "fp": F.lit(0.5), "label": F.lit(None).cast("string")})


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def given(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


def brute_phrases(data):
    """(doc_id, words, removed words, kept text) of each (doc_id, text)."""
    first, texts = {}, {}
    for d, t in data:
        texts.setdefault(-1 if d is None else d, []).append(WORD.findall(t or ""))
    for d in sorted(texts):
        for ws in texts[d]:
            for i in range(len(ws) - 19):
                key = tuple(ws[i : i + 20])
                first[key] = min(first.get(key, (d, i)), (d, i))
    want = []
    for d, t in data:
        ws = WORD.findall(t or "")
        k = -1 if d is None else d
        gone = set()
        for i in range(len(ws) - 19):
            if first[tuple(ws[i : i + 20])] < (k, i):
                gone |= set(range(i, i + 20))
        want.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(want, key=repr)


def test_phrases(docs):
    want = brute_phrases([(d, t) for d, t, _ in given(docs)])
    assert rows(phrases.dedup_phrases(docs), "doc_id", "n_words", "n_removed", "kept") == want


def test_phrases_of_a_hot_anchor_in_many_contexts(spark):
    """A saying of 12 words stands in every text among different words, a passage of 26 in a third of them."""
    rng = np.random.default_rng(13)
    saying, passage = " ".join(f"say{i}" for i in range(12)), " ".join(f"pass{i}" for i in range(26))
    fill = lambda n: " ".join(f"f{x}" for x in rng.integers(0, 5, n))
    data = [(i, f"{fill(9)} {saying} {fill(9)} {passage if i % 3 == 0 else ''} {fill(7)}") for i in range(120)]
    data += [(200, data[5][1]), (5, data[5][1]), (5, data[6][1]), (201, data[7][1] + " " + data[7][1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, low int, h string")
    for words in (phrases.SHARD_WORDS, 300):
        assert rows(phrases.dedup_phrases(df, shard_words=words), "doc_id", "n_words", "n_removed", "kept") == brute_phrases(data)


def test_phrases_in_small_shards(spark):
    d = table(spark, SF, "documents")
    cols = ("doc_id", "n_removed", "kept")
    assert rows(phrases.dedup_phrases(d, shard_words=300), *cols) == rows(phrases.dedup_phrases(d), *cols)


def test_phrases_of_a_text_with_more_words_than_letters():
    many = " ".join(f"w{i}" for i in range(40))
    shard = [(many, 7, 5, 1), (" ".join(f"w{i}" for i in range(5, 35)), 3, 100, 1)]
    assert sorted(phrases.located(shard, 20)) == [(0, 5, 11, 3, 100), (1, 0, 11, 3, 100)]
    assert 3 * 32 * (phrases.SHARD_WORDS // (3 * 32)) <= phrases.SHARD_WORDS < 0x110000 - 2049


def test_phrases_in_huge_texts(spark):
    """Two texts of 1.2 million distinct words that share one passage."""
    shared = [f"s{i}" for i in range(50)]
    data = [(k, " ".join([*(f"{k}w{i}" for i in range(600_000)), *shared, *(f"{k}v{i}" for i in range(600_000))])) for k in (1, 2)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in phrases.dedup_phrases(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: (1_200_050, 0), 2: (1_200_050, 50)}


def test_base_metrics(docs):
    want = []
    for d, t, _ in given(docs):
        t = t or ""
        ws, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
        cov = {j for i in range(len(ws) - 7) if grams[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
        want.append((d, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cov), len(ws) < 20 or 100 * len(cov) > 30 * len(ws)))
    got = rows(line_frequency.base_metrics(docs.select("doc_id", "source", "text")), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(want, key=repr)


def test_strip_lines(docs):
    data = sorted({(d, t, s) for d, t, s in given(docs)}, key=repr)
    norm = lambda x: " ".join(WORD.findall(x)).lower()
    n = Counter(p for d, t, s in data for p in {(s, norm(x)) for x in (t or "").split("\n")})
    cut = lambda t, s: t and "\n".join(x for x in t.split("\n") if not norm(x) or n[s, norm(x)] <= 1)
    want = sorted(((d, s, cut(t, s)) for d, t, s in given(docs)), key=repr)
    assert rows(line_frequency.strip_lines(docs, max_docs=1), "doc_id", "source", "text") == want


def test_line_frequency_query_returns_cleaned_text(spark, tmp_path):
    own = lambda i, n: " ".join(f"own{i}x{k}" for k in range(n))
    menu = "Home  About " + " ".join(f"menu{k}" for k in range(28))
    many = [(i, own(i, 40) + "\n" + menu.upper() + "\n\n" + own(-i, 5), "hot") for i in range(51)]
    poor = [(100, own(100, 29) + "\n" + menu, "hot"), (101, own(101, 25) + "\n" + menu, "cold")]
    again = [(102, own(102, 30) + "\n" + own(103, 30), "hot")] * 51
    spark.createDataFrame(many + poor + again, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = line_frequency.op3_line_frequency(spark, str(tmp_path)).collect()
    by = {r["doc_id"]: (r["text"], r["kept"]) for r in got}
    assert len(got) == 104
    assert all(by[i] == (own(i, 40) + "\n\n" + own(-i, 5), True) for i in range(51))
    assert by[100] == (own(100, 29), False) and by[101] == (poor[1][1], True) and by[102] == (again[0][1], True)


def test_simhash(docs):
    fps = []
    for d, t, _ in given(docs):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        ws = WORD.findall(low)
        hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 3]), seed=42) for i in range(max(1, len(ws) - 2))] if ws else []
        fps.append((d, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))))
    comp = {fp: fp for _, fp in fps}
    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in list(comp):
        for b in list(comp):
            if (a ^ b).bit_count() <= 2:
                comp[find(a)] = find(b)
    low = {}
    for d, fp in fps:
        if d is not None:
            low[find(fp)] = min(d, low.get(find(fp), d))
    want = sorted(((d, fp, low.get(find(fp))) for d, fp in fps), key=repr)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == want


def test_simhash_links(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 20)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(bit)
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert len(want) > 100 and sorted((r["a"], r["b"]) for r in got) == sorted(want)


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(int(a), int(b)) for a, b in rng.integers(0, 90, (60, 2))]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_bpe_and_token_files(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.word_bpe_path())
    data = given(docs)
    enc = [tok.encode(t or "", add_special_tokens=False).ids for _, t, _ in data]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(d, len(e), sha(" ".join(map(str, e))), sha(tok.decode(e, skip_special_tokens=False))) for (d, _, _), e in zip(data, enc)]
    got = rows(bpe.encode_digests(docs, bpe.word_bpe_path()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=repr)

    token_files.write_blocks(docs, bpe.word_bpe_path(), str(tmp_path / "t"), block_ids=700)
    back = token_files.read_blocks(spark, str(tmp_path / "t")).toPandas()
    back = back.sort_values("start", kind="stable")
    at = 0
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is not None, data[i][0] or 0))
    assert [None if pd.isna(x) else x for x in back["doc_id"]] == [data[i][0] for i in order]
    for s, n, raw in zip(back["start"], back["n_tokens"], back["ids"]):
        assert s == at and n == len(raw) // 4
        at += n
    unique = Counter(d for d, _, _ in data)
    ids = {d: np.array([*e, 1], "<u4").tobytes() for (d, _, _), e in zip(data, enc)}
    assert all(raw == ids[d] for d, raw in zip(back["doc_id"], back["ids"]) if not pd.isna(d) and unique[d] == 1)


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5, 5, 1000, 1_000_000], list(range(0, 90_000, 7)), [0] * 900 + [1 << 33]])
def test_elias_fano(values):
    ef = token_files.EliasFano.encode(np.array(values))
    back = token_files.EliasFano(ef.low_bits, ef.low.tobytes(), ef.high.tobytes(), ef.marks.tobytes(), ef.n)
    assert back.values().tolist() == values
    assert [back.select(i) for i in range(0, len(values), 13)] == values[::13]


def test_block_offsets_come_from_select(monkeypatch):
    values = [0, 0, 3, *range(900, 90_000, 7)]
    ef = token_files.EliasFano.encode(np.array(values))
    monkeypatch.setattr(token_files.EliasFano, "values", None)
    assert token_files._offsets(ef).tolist() == values


def test_line_windows(docs):
    by = {}
    for d, t, _ in given(docs):
        by[d, t] = (t or "").split("\n")
    wins = {}
    for (d, t), ls in by.items():
        solid = [i for i, x in enumerate(ls) if WORD.search(x)]
        for k in range(len(solid) - 2):
            w = solid[k : k + 3]
            wins.setdefault(tuple(ls[i] for i in w), []).append(((d is not None, d or 0), w[0], (d, t), w))
    gone = {}
    for places in wins.values():
        for *_, key, w in sorted(places)[1:]:
            gone.setdefault(key, set()).update(w)
    want = []
    for d, t, _ in given(docs):
        cut = gone.get((d, t), set())
        want.append((d, len(by[d, t]), len(cut), "\n".join(x for i, x in enumerate(by[d, t]) if i not in cut) if t is not None else None))
    assert rows(line_windows.dedup_lines(docs), "doc_id", "_n_lines", "_n_removed", "_kept") == sorted(want, key=repr)


def test_language(spark, docs):
    model = ppm.train(table(spark, SF, "documents"))
    full = ppm.predict(docs, model).collect()
    assert len(full) == docs.count()
    for r in full:
        none = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == none and 0 <= r["lang_score"] <= 1
    empty = ppm.train(docs.limit(0))
    assert {r["lang_pred"] for r in ppm.predict(docs, empty).collect()} <= {"und"}


def test_language_held_out_accuracy(spark):
    got = ppm.op2_ppm(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id").where("held_out AND lang_pred <> 'und'")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def _blend(full: np.ndarray) -> np.ndarray:
    """Dense form of ``ppm.code_lengths`` for two-symbol contexts (method C)."""
    prob = np.full(full.shape[0], 1.0 / full.shape[0])
    for counts in (full.sum(axis=(0, 1)), full.sum(axis=0), full):
        total, kinds = counts.sum(axis=-1, keepdims=True), (counts > 0).sum(axis=-1, keepdims=True)
        norm = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, kinds / norm, 1.0)
        # a symbol seen here is coded here; others pay the escape and their shorter context
        prob = np.where(counts > 0, counts / norm, escape * prob)
    return prob


def test_code_lengths_are_probabilities():
    counts = np.random.default_rng(1).integers(0, 4, (5, 5, 5)).astype(float)
    p = _blend(counts)
    assert p.min() > 0 and p.sum(axis=-1).max() <= 1 + 1e-9


def test_sparse_code_lengths_are_those_of_the_dense_table():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 3, 40).astype(np.uint8)) for _ in range(6)]
    g, n = np.unique(ppm._grams([ppm.LEAD + t for t in texts]), return_counts=True)
    tables = ppm._tables(g, n)
    dense = np.zeros((256,) * 3, dtype=np.float32)
    for x, c in zip(g, n):
        dense[x >> 16 & 255, x >> 8 & 255, x & 255] += c
    p = _blend(dense)
    every = [a << 16 | b << 8 | c for a in (0, 1, 2, 10, 200) for b in (0, 1, 2, 10, 200) for c in (0, 1, 2, 200, 255)]
    got = ppm.code_lengths(np.array(every), tables[:3])
    assert np.allclose(got, [-np.log(p[x >> 16, x >> 8 & 255, x & 255]) for x in every], rtol=1e-4)
    full = np.array([x << 8 | c for x in np.unique(g >> 8)[:50] for c in range(256)])
    total = np.exp(-ppm.code_lengths(full, tables)).reshape(-1, 256).sum(axis=1)
    assert total.max() <= 1 + 1e-9 and total.min() > 0.2


def test_language_keeps_rare_scripts_apart(spark):
    rng = np.random.default_rng(4)
    say = lambda lo, hi: " ".join("".join(map(chr, rng.integers(lo, hi, 5))) for _ in range(40))
    big = "".join(map(chr, range(32, 127))) + "".join(map(chr, [*range(0x430, 0x460), *range(0x3041, 0x30FF)]))
    data = [(i, big * 20, "big") for i in range(60)]
    # one continuation byte range; only the lead bytes of the two scripts differ
    data += [(100 + i, say(0x78A, 0x7A6), "thaana") for i in range(4)] + [(200 + i, say(0x7CA, 0x7E6), "nko") for i in range(4)]
    model = ppm.train(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    ask = [(i, say(*[(0x78A, 0x7A6), (0x7CA, 0x7E6)][i % 2])) for i in range(20)] + [(20, big)]
    got = dict(ppm.predict(spark.createDataFrame(ask, "doc_id long, text string"), model).select("doc_id", "lang_pred").collect())
    assert got == {i: ["thaana", "nko"][i % 2] for i in range(20)} | {20: "big"}


def test_long_text_is_coded_whole(spark, monkeypatch):
    known = spark.createDataFrame([(1, "abra cadabra " * 30, "a"), (2, "hocus pocus " * 30, "b")], "doc_id long, text string, lang string")
    model = ppm.train(known)
    texts = ["abra " * 9 + "hocus " * 9, "é", "cadabra", "pocus abra " * 50]
    want = [[ppm.code_lengths(ppm._grams([ppm.LEAD + t.encode()]), m).sum() for m in model["tables"]] for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for size in (1 << 20, 7):
        monkeypatch.setattr(ppm, "_SLICE", size)
        got = [r["lang_score"] for r in ppm.predict(docs, model).orderBy("doc_id").collect()]
        assert np.allclose(got, [1 / np.exp(min(w) - np.array(w)).sum() for w in want])


def test_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((12, 16))
    data = []
    for i in range(240):
        v = base[i % 12] + rng.standard_normal(16) * 0.08 * (i % 5)
        data.append((i, [float(np.float32(x)) for x in v], i % 3))
    data += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, data[0][1], None), (305, data[0][1], 0), (306, data[0][1], 0), (307, [], 0), (308, [1.0, 2.0], 0), (309, [1.0, 2.0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit(1)).withColumn("rep", F.lit("x"))
    ok = [(i, np.array(v, float), lab) for i, v, lab in data if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    root, n = {d[0]: d[0] for d in data}, Counter()
    pairs = [(a[0], b[0]) for k, a in enumerate(ok) for b in ok[k + 1 :] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= 0.93]
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    for _ in range(50):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    want = sorted(((d[0], n[d[0]], root[d[0]], root[d[0]] == d[0]) for d in data), key=repr)
    assert rows(hyperplanes.near_duplicate_vectors(df), "vec_id", "n_links", "component_id", "kept") == want
    assert hyperplanes.near_duplicate_vectors(df.limit(0)).count() == 0


def test_mixing(docs):
    out = mixing.mix(docs, F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))).collect()
    again = mixing.mix(docs.repartition(3), F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))).collect()
    key = lambda rs: sorted(((r["doc_id"], r["source"], r["_epochs"]) for r in rs), key=repr)
    assert len(out) == docs.count() and key(out) == key(again)
    took, target, largest = Counter(), {}, Counter()
    for r in out:
        s = r["source"]
        took[s] += r["_epochs"] * r["_size"]
        target[s], largest[s] = r["_target"], max(largest[s], r["_size"])
        assert 0 <= r["_epochs"] <= 2 and r["_target"] <= 2 * r["_source_size"] + 1e-6
    assert all(abs(took[s] - target[s]) <= 2 * largest[s] for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(r["_size"] for r in out)) < 1e-3


def test_water_fill():
    assert mixing.water_fill([100, 10, 10], [1, 1, 1], 60, 2) == [20, 20, 20]
    assert mixing.water_fill([100, 1, 10], [1, 8, 1], 22, 2) == [10, 2, 10]
    assert mixing.water_fill([], [], 0, 2) == [] and mixing.water_fill([0, 4], [3, 1], 6, 2) == [0, 6]


def test_toxicity(spark, docs):
    model = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["toxic_score"] <= 1 for r in got)
    none = toxicity.train(docs.limit(0), table(spark, SF, "labels").limit(0))
    assert all(r["toxic_score"] < 0.5 for r in toxicity.score(docs, none).collect())


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op10_toxicity(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id").toPandas()
    pos, neg = got.loc[got.toxic == 1, "score"], got.loc[got.toxic == 0, "score"]
    auc = (pos.to_numpy()[:, None] > neg.to_numpy()).mean()
    assert auc > 0.75 and (neg >= 0.5).mean() < 0.05 and (pos >= 0.5).mean() > 0.4


def test_language_needs_a_letter_and_takes_clashing_names(spark):
    model = ppm.train(table(spark, SF, "documents"))
    texts = ["½", "²", "Ⅷ", "①", "12 _ !", "\u0301", "é", "ª", "\u4e00"]
    asked = spark.createDataFrame([(i, t, "old", 9) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, lang_score int")
    got = {r["doc_id"]: r["lang_pred"] for r in ppm.predict(asked, model).collect()}
    assert [got[i] == "und" for i in range(len(texts))] == [True] * 6 + [False] * 3


def test_code_lengths_of_order_four_by_hand():
    """Method C written out per byte: escape through each seen, longer context."""
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 100, int(rng.integers(1, 60))).astype(np.uint8)) for _ in range(8)]
    seen = [Counter() for _ in range(5)]
    for t in texts:
        t = ppm.LEAD + t
        for i in range(4, len(t)):
            for k in range(5):
                seen[k][t[i - k : i], t[i]] += 1

    def nats(t, i):
        out = 0.0
        for k in (4, 3, 2, 1, 0):
            here = {b: n for (c, b), n in seen[k].items() if c == t[i - k : i]}
            if not here:
                continue
            norm = sum(here.values()) + len(here)
            if t[i] in here:
                return out - np.log(here[t[i]] / norm)
            out -= np.log(len(here) / norm)
        return out + np.log(256)

    g, n = np.unique(ppm._grams([ppm.LEAD + t for t in texts]), return_counts=True)
    tables = ppm._tables(g, n)
    for t in [b"abcabc", b"zzz", b"aab\xffcab", texts[0]]:
        t = ppm.LEAD + t
        got = ppm.code_lengths(ppm._grams([t]), tables)
        assert np.allclose(got, [nats(t, i) for i in range(4, len(t))])


def test_language_sample_is_bounded_per_language(spark):
    docs = spark.createDataFrame([(i, f"text number {i % 700}", "a" if i % 3 else "b") for i in range(4000)] + [(9, "same", "a")] * 4000, "doc_id long, text string, lang string")
    small, whole = ppm.train(docs, max_docs=50), ppm.train(docs, max_docs=10_000)
    assert small["langs"] == whole["langs"] == ["a", "b"]
    assert all(len(s[4][0]) < len(w[4][0]) for s, w in zip(small["tables"], whole["tables"]))


def test_risk_gradient():
    """The direction is the risk's numeric derivative, or that of the negative part with its sign turned."""
    rng = np.random.default_rng(8)
    is_p = np.arange(30) < 10
    for shift, prior in ((0.0, 0.2), (-4.0, 0.5), (3.0, 0.5)):
        z = rng.normal(0, 1, 30) + np.where(is_p, -shift, shift)
        lp = lambda v: np.log1p(np.exp(v))
        pos = lambda z: prior * lp(-z[is_p]).mean()
        neg = lambda z: lp(z[~is_p]).mean() - prior * lp(z[is_p]).mean()
        value, g = toxicity.risk(z, is_p, prior)
        assert np.isclose(value, pos(z) + max(0, neg(z)))
        whole = (lambda z: pos(z) + neg(z)) if neg(z) >= 0 else (lambda z: -neg(z))
        for i in range(30):
            e = np.eye(30)[i] * 1e-6
            assert np.isclose(g[i], (whole(z + e) - whole(z - e)) / 2e-6, atol=1e-6)


def test_toxicity_takes_awkward_rows(spark):
    rows = [(i, f"fine words number {i}") for i in range(60)] + [(i, f"vile slur {i}") for i in range(60, 70)] + [(200, "vile slur again")] * 300 + [(None, "vile"), (71, None), (72, ""), (73, "vile " * 50_000)]
    docs = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, toxic_score double")
    labels = spark.createDataFrame([(i, int(i >= 60), "x") for i in range(20, 70)] + [(60, 0, "x"), (61, None, "x"), (None, 1, "x")], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.score(docs, model).collect()}
    assert len(got) == 75 and got[200] > 0.5 > got[10] and got[73] > 0.5
    assert len(toxicity._sample(docs, 20, 1)) == 20 and len(toxicity._sample(docs, 1000, 1)) == 75


def test_mixing_takes_part_of_equal_rows(spark):
    """100 equal rows of 4 words: a target of 602.5 words takes 50 of them twice."""
    same = [(1, "one two three four", "a")] * 100
    other = [(i, "x y " * (i % 9), "b") for i in range(2, 300)] + [(2, None, None), (3, "", None), (4, "z " * 500, None)]
    docs = spark.createDataFrame([(*r, 7, "q") for r in same + other], "doc_id long, text string, source string, _size int, _src string")
    size = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != ""))
    out = mixing.mix(docs, size).collect()
    assert len(out) == len(same + other) and Counter((r["doc_id"], r["text"], r["source"]) for r in out) == Counter(same + other)
    took, target, largest = Counter(), {}, Counter()
    for r in out:
        took[r["source"]] += r["_epochs"] * r["_size"]
        target[r["source"]] = r["_target"]
        largest[r["source"]] = max(largest[r["source"]], r["_size"])
        assert r["_size"] == len((r["text"] or "").split()) and 0 <= r["_epochs"] <= 2
    assert all(0 <= target[s] - took[s] <= largest[s] for s in target)
    again = mixing.mix(docs.repartition(7), size).collect()
    assert Counter((r["doc_id"], r["text"], r["_epochs"]) for r in again) == Counter((r["doc_id"], r["text"], r["_epochs"]) for r in out)


def test_mixing_query_against_brute_force(spark):
    """Targets by repeated clamping in exact fractions; each source's taken words within one document below its target."""
    from fractions import Fraction

    out = mixing.op9_mixing(spark, SF).collect()
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    assert len(out) == len(docs) == len({r["doc_id"] for r in out})
    size = {i: len(WORD.findall(r["text"] or "")) for i, r in docs.items()}
    total = Counter()
    for i, r in docs.items():
        total[r["source"]] += size[i]
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    want, free, left = {}, set(names), Fraction(3 * sum(total.values()), 2)
    while free:
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if shares[s] > 2 * total[s]}
        want.update({s: Fraction(2 * total[s]) if s in over else shares[s] for s in (over or free)})
        left -= sum(want[s] for s in over)
        free = free - over if over else set()
    took = Counter()
    for r in out:
        s = docs[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s]) and abs(r["target"] - float(want[s])) < 1e-6
        assert r["taken"] in {k * r["size"] for k in (0, 1, 2)}
        took[s] += r["taken"]
    biggest = {s: max(size[i] for i, r in docs.items() if r["source"] == s) for s in names}
    assert all(0 <= want[s] - took[s] <= biggest[s] for s in names)


def test_vectors_of_repeated_ids_keep_their_labels_apart(spark):
    a, b, c, near_b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [0.0, 1.0, 0.1]
    rows = [(5, a, "x"), (5, b, "y"), (7, c, "x"), (8, near_b, "x"), (9, a, "x"), (5, [0.1, 1.0, 0.0], "y"), (None, c, "x"), (None, c, None)]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id long, embedding array<double>, label string, m double")
    got = Counter(tuple(r) for r in hyperplanes.near_duplicate_vectors(df).collect())
    assert got == Counter([(5, 1, 5, True), (5, 1, 5, True), (5, 1, 5, True), (7, 1, 7, True), (None, 1, 7, False), (8, 0, 8, True), (9, 1, 5, False), (None, 0, None, True)])


def test_vectors_of_extreme_size_are_compared(spark):
    rows = [(i, [s * 1.0, s * 0.2, 0.0], 1) for i, s in enumerate((1e200, 1e-200, 1.0, 5e-324, 1e308))] + [(9, [0.0, 0.0, 1e-300], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hyperplanes.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {0: (4, 0), 1: (4, 0), 2: (4, 0), 3: (4, 0), 4: (4, 0), 9: (0, 9)}


def test_vector_recall_in_one_wide_label(spark):
    """6,000 vectors of 64 dimensions in one label, thousands of pairs near the limit: recall of 0.99 or more, none below the limit."""
    rng = np.random.default_rng(17)
    base = rng.standard_normal((1200, 64))
    v = np.concatenate([base + rng.standard_normal((1200, 64)) * s for s in (0.0, 0.18, 0.24, 0.27, 0.30)])
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in hyperplanes.near_duplicate_vectors(df).collect()}
    found = sum(got.values())
    assert links.sum() > 2000 and all(got[i] <= n for i, n in enumerate(links)) and found >= 0.99 * links.sum()


@pytest.mark.parametrize("small, block", [(1, 3), (8, 50)])
def test_vectors_in_crowded_buckets(spark, small, block):
    """Two groups of near copies and loose neighbours: every size of bucket and block gives the same exact counts."""
    rng = np.random.default_rng(21)
    a, b = rng.standard_normal((2, 16))
    near = [a + rng.standard_normal(16) * 0.02 for _ in range(60)] + [b + rng.standard_normal(16) * s for s in rng.uniform(0.05, 0.4, 60)]
    data = [(i, x.tolist(), i % 2) for i, x in enumerate(near)] + [(900, near[0].tolist(), 0), (901, near[0].tolist()[:8], 0), (902, near[2].tolist()[:8], 0)]
    want_n, root = Counter(), {r[0]: r[0] for r in data}
    for i, (p, x, k) in enumerate(data):
        for q, y, j in data[i + 1 :]:
            if k == j and len(x) == len(y) and np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)) >= 0.93:
                want_n[p] += 1
                want_n[q] += 1
                low, high = sorted((root[p], root[q]))
                root = {v: low if r == high else r for v, r in root.items()}
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hyperplanes.near_duplicate_vectors(df, miss=1e-6, small=small, block=block).collect()}
    assert sum(want_n.values()) > 2000 and got == {v: (want_n[v], root[v]) for v in root}


def _written(spark, tmp_path):
    """The awkward rows, one of each id, as a documents table."""
    data = [r for r in ROWS if r[0] != 13] + [(13, "same", "en", "a"), (15, "ünïcode  wörds, 3 of them", "de", "b")]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return [(r[0], r[1]) for r in data]


def test_op7_query_columns(spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.word_bpe_path())
    at, want = 0, []
    for d, t in sorted(_written(spark, tmp_path), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = token_files.op7_token_files(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)


def test_op4_query_columns(spark, tmp_path):
    want = {d: f"{simhash.fingerprint(t):016x}" for d, t in _written(spark, tmp_path)}
    got = simhash.op4_simhash(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == want and len(got) == len(want)
    near = {d: min(x for x in want if x is not None and want[x] == want[d]) for d in want if d is not None}
    assert all(r["component_id"] <= near[r["doc_id"]] for r in got if r["doc_id"] is not None)


def test_id_encoder_on_awkward_strings():
    """Ids of the library for Latin, composing and other scripts, special tokens and rare white space."""
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(bpe.word_bpe_path()), bpe.IdEncoder(bpe.word_bpe_path(), remember=50)
    rng = np.random.default_rng(5)
    pool = [chr(c) for c in range(0x260)] + list("abc ABC'st'réé\t\n \u0085 İıſßǅ½²ªÅﬁ中あ한​Σςσ") + ["\U0001f600", "<|endoftext|>", "é"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 40))) for _ in range(1500)]
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert own.packed(t) == np.array(e.ids, "<u4").tobytes()


def test_strip_lines_deals_texts_by_document_at_every_size(spark):
    """Few gone lines are not sent whole while many are shuffled: the bytes moved grow with the input."""
    docs = spark.createDataFrame([(i, f"same line\nown {i}", "a") for i in range(4)], "doc_id long, text string, source string")
    out = line_frequency.strip_lines(docs, max_docs=3)
    assert "SortMergeJoin [doc_key" in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out, "doc_id", "text") == [(i, f"own {i}") for i in range(4)]


def test_id_store_outlives_its_method():
    """The class travels by value: a later task of the same worker replaces its functions."""
    import gc
    import types

    class Sent(bpe.IdEncoder):
        word = types.FunctionType(bpe.IdEncoder.word.__code__, bpe.IdEncoder.word.__globals__, "word", None, bpe.IdEncoder.word.__closure__)

    enc = Sent(bpe.word_bpe_path(), remember=10)
    Sent.word = bpe.IdEncoder.word
    gc.collect()
    assert enc.packed("some words") == bpe.IdEncoder(bpe.word_bpe_path()).packed("some words")


def test_mixing_wordless_texts_take_no_epoch_beyond_the_limit(spark):
    """A source that is taken whole twice has nothing left to share: its empty texts get no third epoch."""
    docs = spark.createDataFrame([(0, "z " * 50, "a")] + [(i, "", "a") for i in range(1, 200)] + [(200, "y " * 5000, "b")], "doc_id long, text string, source string")
    out = mixing.mix(docs, F.size(F.filter(F.split("text", " "), lambda w: w != ""))).collect()
    assert len(out) == 201 and max(r["_epochs"] for r in out) == 2


def test_repeat_words_hash_a_word_once_and_windows_by_doubling(spark):
    """Windows are hashed from the hashes of shorter ones, not word by word; any width, overlaps and repeats included."""
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(list("abcd"), n)) for n in [*range(14), *rng.integers(9, 90, 40)]]
    texts += [" ".join(map(str, range(40))), " ".join(["x"] * 30), " ".join(["p q r"] * 9), " ".join(map(str, [*range(20), *range(5, 14)]))]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    ws = line_frequency.words(F.col("text"))
    for width in (3, 5, 8):
        got = dict(df.select("doc_id", line_frequency._repeat_words(ws, width)).collect())
        for i, t in enumerate(texts):
            w = t.split()
            at = range(len(w) - width + 1)
            n = Counter(tuple(w[k : k + width]) for k in at)
            assert got[i] == len({k + j for k in at if n[tuple(w[k : k + width])] > 1 for j in range(width)})
    assert "xxhash64(slice(" not in line_frequency.base_metrics(df)._jdf.queryExecution().analyzed().toString()


def test_simhash_tables_are_dealt_at_every_size(spark):
    # small enough to be sent whole, had the explode not multiplied the rows
    found = simhash.links(spark.range(2000).select(F.xxhash64("id").alias("fp")))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    out = simhash.near_duplicates(table(spark, "/root/testdata/sf0.001", "documents"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[fp#", plan)) == 3  # the ids of each fingerprint, and its root on both sides
