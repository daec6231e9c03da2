"""BPE encoding by forced-boundary splitting, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import weakref
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from creamery.llm.common import table


_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Store(dict):
    """Remembers what an encoder's ``word`` gives for a word; emptied when full, so memory stays bounded.

    It does not hold the encoder, which so goes with its last user and not
    with the next cycle collection: vocabularies are large. The method is
    looked up at each use: the class travels by value, and when a later task
    of a worker brings it again, its functions are replaced.
    """

    def __init__(self, encoder: "Encoder", most: int):
        self.encoder, self.most = weakref.ref(encoder), most

    def __missing__(self, word: str):
        out = self.encoder().word(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = out
        return out


def _latin(pattern: str) -> re.Pattern:
    """``pattern`` for texts up to U+024F, with its Unicode classes written out."""
    for name, full in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"\p{White_Space}")):
        pattern = pattern.replace(name, "".join(re.escape(chr(c)) for c in range(0x250) if regex.match(full, chr(c))))
    return re.compile(pattern)


class Encoder:
    """Encodes as a word-BPE file of the tokenizers library says.

    Two neighbouring symbols that no vocabulary token holds side by side can
    never be merged over, so each pre-token is cut there, the library's merge
    step runs on each fragment alone and the ids are joined. ``remember`` words
    keep their ids.
    """

    def __init__(self, path: str, remember: int = 200_000):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names.update({i: t for t, i in self.special.items()})
        merges = [tuple(m) for m in model["merges"]]
        # a fragment before a cut ends inside its word; only the final one takes the suffix
        self.inner = models.BPE(self.vocab, merges)
        self.final = models.BPE(self.vocab, merges, end_of_word_suffix=self.end) if self.end else self.inner
        self.normal = Tokenizer.from_file(path).normalizer
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.split = _latin(split["pattern"]["Regex"])
        self.any_split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.bytes = dict(enumerate(byte_symbols()))
        self.inside = {p for t in self.vocab for p in zip(self.symbols(t), self.symbols(t)[1:])}
        self.known = _Store(self, remember)

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def word_ids(self, w: str) -> list[int]:
        """Ids of one pre-token."""
        s = w.encode().decode("latin-1").translate(self.bytes)
        ids, start = [], 0
        if len(s) > 1 and not (self.inside.issuperset(zip(s, s[1:-1])) and (s[-2], s[-1] + self.end) in self.inside):
            for i, pair in enumerate([*zip(s, s[1:-1]), (s[-2], s[-1] + self.end)], 1):
                if pair not in self.inside:
                    ids += [t.id for t in self.inner.tokenize(s[start:i])]
                    start = i
        return ids + [t.id for t in self.final.tokenize(s[start:])]

    def word(self, w: str) -> tuple[tuple[int, ...], str, str]:
        """Ids of one pre-token, with their decimal and decoded forms."""
        ids = self.word_ids(w)
        return tuple(ids), " ".join(map(str, ids)), " ".join([self.names[i] for i in ids])

    def pieces(self, text: str | None) -> Iterator[tuple[bool, str | list[str]]]:
        """Special tokens (True, token) and, between them, the pre-tokens (False, list) of ``text``."""
        for k, piece in enumerate(self.at_special.split(text or "")):
            if k % 2:
                yield True, piece
            elif piece:
                # the normalizer composes, lower-cases and joins white space, which the split passes over;
                # up to U+024F nothing composes
                plain = piece.lower()
                if _BEYOND_LATIN.search(piece) or _BEYOND_LATIN.search(plain):
                    plain = self.normal.normalize_str(piece)
                    # the regex engines know different Unicode versions: beyond Latin the library's own splits
                    yield False, [w for w, _ in self.any_split.pre_tokenize_str(plain)] if _BEYOND_LATIN.search(plain) else self.split.findall(plain)
                else:
                    yield False, self.split.findall(plain)

    def parts(self, text: str | None) -> list[tuple[tuple[int, ...], str, str]]:
        known, out = self.known, []
        for special, found in self.pieces(text):
            if special:
                i = self.special[found]
                out.append(((i,), str(i), found))
            else:
                out += map(known.__getitem__, found)
        return out

    def decode(self, ids) -> str:
        return " ".join(self.names[i] for i in ids)


class IdEncoder(Encoder):
    """An ``Encoder`` that gives ids only; its store holds them as packed 32-bit integers."""

    def word(self, w: str) -> bytes:
        ids = self.word_ids(w)
        return struct.pack(f"<{len(ids)}I", *ids)

    def packed(self, text: str | None) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        for special, found in self.pieces(text):
            out.append(self.special[found].to_bytes(4, "little") if special else b"".join(map(known.__getitem__, found)))
        return b"".join(out)

    @staticmethod
    def of_worker(path: str) -> "IdEncoder":
        """The one encoder of this Python worker: it outlives a task, as the worker does.

        The subpackage travels by value, so its own globals do not; an
        imported module's do.
        """
        import tokenizers

        held = tokenizers.__dict__.setdefault("_id_encoders", {})
        if path not in held:
            held[path] = IdEncoder(path, remember=600_000)
        return held[path]


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of ``docs`` (doc_id, text).

    Null and empty texts have no ids. Each of several equal rows is encoded;
    long texts are encoded whole, piece by piece; an empty table gives no
    rows; other columns are not read.
    """

    def run(batches):
        enc = Encoder(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            n, ids, dec = [], [], []
            for text in b["text"]:
                p = enc.parts(text.as_py())
                n.append(sum(len(x[0]) for x in p))
                ids.append(sha(" ".join(x[1] for x in p)))
                dec.append(sha(" ".join(x[2] for x in p)))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(dec, pa.string())], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), word_bpe_path())
