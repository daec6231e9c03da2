"""Language ID by prediction by partial matching over byte contexts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.common import held_out, table

_LETTER = regex.compile(r"\p{L}")
#: Longest context in bytes, and what stands before a text.
ORDER = 4
LEAD = b"\n" * ORDER
#: Bytes coded at once.
_SLICE = 1 << 20


def _grams(pieces: list[bytes]) -> np.ndarray:
    """Each byte of the pieces but their ``ORDER`` first ones, with its ``ORDER`` predecessors, as one number."""
    x = np.frombuffer(b"".join(pieces), dtype=np.uint8).astype(np.int64)
    g = np.zeros(len(x) - ORDER, dtype=np.int64)
    for k in range(ORDER + 1):
        g = g << 8 | x[k : k + len(g)]
    here = np.ones(len(g), dtype=bool)
    ends = np.cumsum([len(p) for p in pieces])[:-1]
    here[(ends[:, None] - np.arange(1, ORDER + 1)).ravel()] = False  # these would cross into the next piece
    return g[here]


def train(docs: DataFrame, max_docs: int = 1500) -> dict:
    """Frozen statistics of ``docs`` (doc_id, text, lang): a bounded sample per language.

    About ``max_docs`` distinct documents of each language give their whole
    texts: those whose hash lies under a limit taken from the language's count
    (all, where there are fewer), so only the sample leaves the scan. Holds,
    for each language and each context length from 0 to ``ORDER``, the seen
    contexts and the seen (context, byte) pairs as sorted arrays with their
    code lengths in nats. All 256 byte values are symbols; the size is bounded
    by the languages and the bytes of their samples. Rows without text or lang
    teach nothing; an empty table gives a model without languages.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.xxhash64(F.lit(3), "doc_id", "text").alias("u"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("u").alias("n")).collect()
    limits = docs.sparkSession.createDataFrame([(r["lang"], int(min(1.0, max_docs / max(r["n"], 1)) * (1 << 32))) for r in sizes], "lang string, top long")
    # one row per language, of which the model holds whole tables
    some = known.join(F.broadcast(limits), "lang").where(F.pmod("u", F.lit(1 << 32)) < F.col("top")).dropDuplicates(["lang", "u"])

    def count(batches):
        for b in batches:
            texts: dict = {}
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                texts.setdefault(lang, []).append(LEAD + text.lower().encode())
            for lang, parts in texts.items():
                g, n = np.unique(_grams(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "g", "n"])

    rows = some.select("lang", "text").mapInArrow(count, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toArrow()
    lang = rows["lang"].combine_chunks().dictionary_encode()
    names, which = lang.dictionary.to_pylist(), lang.indices.to_numpy()
    g, n = rows["g"].to_numpy(), rows["n"].to_numpy()
    langs = sorted(names)
    return {"langs": langs, "tables": [_tables(g[m], n[m]) for m in (which == names.index(x) for x in langs)]}


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sum of ``n`` and the number of entries of each."""
    seen, at, kinds = np.unique(keys, return_inverse=True, return_counts=True)
    return seen, np.bincount(at, n, len(seen)), kinds


def _tables(g: np.ndarray, n: np.ndarray, order: int = ORDER) -> list[tuple]:
    """(pairs, cost, contexts, escape) of each context length: code lengths of method C."""
    out = []
    for k in range(order + 1):
        pairs, counts, _ = _sums(g & ((1 << 8 * (k + 1)) - 1), n)
        contexts, total, kinds = _sums(pairs >> 8, counts)
        norm = total + kinds
        cost = np.log(norm[np.searchsorted(contexts, pairs >> 8)]) - np.log(counts)
        out.append((pairs, cost, contexts, np.log(norm) - np.log(kinds)))
    return out


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in the sorted ``table``, and which of them are there."""
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, table[at] == keys if len(table) else np.zeros(len(keys), dtype=bool)


def code_lengths(grams: np.ndarray, tables: list[tuple]) -> np.ndarray:
    """Nats of the last byte of each gram after its longest seen context, escapes included."""
    out = np.zeros(len(grams))
    rest = np.arange(len(grams))
    for k in range(len(tables) - 1, -1, -1):
        pairs, cost, contexts, escape = tables[k]
        keys = grams[rest] & ((1 << 8 * (k + 1)) - 1)
        at, here = _found(pairs, keys)
        out[rest[here]] += cost[at[here]]
        rest, keys = rest[~here], keys[~here]
        at, here = _found(contexts, keys >> 8)
        out[rest[here]] += escape[at[here]]
    out[rest] += np.log(256)
    return out


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and lang_score, from each whole text alone.

    A text that is null or has no letter gets ``und`` and score 0. Texts are
    read in slices, so very long ones need no more memory. Score: the share of
    the best language when code lengths are turned into probabilities. Columns
    named lang_pred or lang_score in ``docs`` are replaced, others pass through.
    """
    spark, docs = docs.sparkSession, docs.drop("lang_pred", "lang_score")
    sent = spark.sparkContext.broadcast(model)  # bounded by the training sample
    names = docs.columns

    def nats(texts: list[bytes], m: dict) -> np.ndarray:
        """Code length of each text (row) in each language (column)."""
        out = np.zeros((len(texts), len(m["langs"])))
        todo: list[tuple[int, bytes]] = []

        def code() -> None:
            # texts repeat their grams: each distinct one is looked up once a language
            seen, at = np.unique(_grams([p for _, p in todo]), return_inverse=True)
            starts = np.cumsum([0, *(len(p) - ORDER for _, p in todo[:-1])])
            for k, tables in enumerate(m["tables"]):
                np.add.at(out[:, k], [i for i, _ in todo], np.add.reduceat(code_lengths(seen, tables)[at], starts))
            todo.clear()

        size = 0
        for i, t in enumerate(texts):
            t = LEAD + t
            for lo in range(0, len(t) - ORDER, _SLICE):
                todo.append((i, t[lo : lo + _SLICE + ORDER]))
                size += len(todo[-1][1])
                if size >= _SLICE:
                    code()
                    size = 0
        if todo:
            code()
        return out

    def run(batches):
        m = sent.value
        langs = m["langs"]
        for b in batches:
            texts = b[text].to_pylist()
            use = [i for i, t in enumerate(texts) if langs and t is not None and _LETTER.search(t)]
            best, score = ["und"] * len(texts), [0.0] * len(texts)
            for i, row in zip(use, nats([texts[i].lower().encode() for i in use], m)):
                best[i] = langs[int(row.argmin())]
                score[i] = float(1 / np.exp(row.min() - row).sum())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "lang_score"])

    schema = docs.withColumn("lang_pred", F.lit("")).withColumn("lang_score", F.lit(0.0)).schema
    return docs.mapInArrow(run, schema)


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
