"""Token counting and token ids with the public tokenizers (operators 10, 6).

Counting goes through distinct pre-tokens: a text is cut where the tokenizer
itself always cuts, documents become frequencies of pre-tokens, every distinct
pre-token of the whole table is encoded once, and a join brings the numbers of
pieces back to the documents.  Texts with characters beyond a few ranges are
cut by the library's own pre-tokenizer; only texts with a special string go
through the library whole.  Ids (for packing) come from a table of parts per
Python process, and there such texts go to the library whole, so that results
always equal the library's.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import map_batches, process_cache, written

#: The split pattern of the byte-level vocabulary (fixed value).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The split pattern of the word vocabulary (fixed value).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"""
#: Letters whose lower case depends on their surroundings or is no single letter.
UNEVEN_CASE = "İΣ"
#: Parts of a text kept with their pieces per process; the table starts anew beyond.
CACHE_PARTS = 800_000
#: Pre-tokens that go to the tasks at most.
COMMON_PARTS = 1 << 16
#: Texts made of these ranges only are cut here; others by the library.
#: Letters, digits, punctuation and spaces of Latin, Greek and Cyrillic text and
#: general punctuation, whose classes have not changed between Unicode versions.
NOT_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏΆ-ϿЀ-ҁҊ-ԧ‐-‧‰-⁞€™]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return process_cache(("tokenizer", path), lambda: Tokenizer.from_file(path))


def _specials(tok) -> tuple[str, ...]:
    return tuple(t.content for t in tok.get_added_tokens_decoder().values())


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the other bytes for the code
    points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = byte_letters()


def _stand_ins(piece: str) -> str:
    if piece.isascii() and piece.isalpha():
        return piece
    return piece.encode().decode("latin-1").translate(_LETTERS)


def _odd(text: str, special: tuple[str, ...]) -> bool:
    """Whether a text must be given to the library whole."""
    return NOT_PLAIN.search(text) is not None or "<|" in text and any(s in text for s in special)


class PreTokens:
    """Cuts texts into pre-tokens and counts the pieces of one."""

    def __init__(self, path: str):
        import regex

        self.tok = _library(path)
        self.merge = self.tok.model.tokenize
        self.special = _specials(self.tok)
        self.cut = regex.compile(BYTE_PATTERN).findall

    def whole(self, text: str) -> int | None:
        """The count of a text that must not be cut: one with a special string."""
        return None if self.special_free(text) else len(self.tok.encode(text, add_special_tokens=False))

    def special_free(self, text: str) -> bool:
        return not any(s in text for s in self.special)

    def of(self, text: str) -> list[str]:
        if NOT_PLAIN.search(text) is None:
            return self.cut(text)
        if self.tok.normalizer is not None:
            text = self.tok.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, part: str) -> int:
        return len(self.merge(_stand_ins(part)))


class PieceCounts(dict):
    """Pieces per distinct pre-token, for counting single texts without a table."""

    def __init__(self, path: str):
        self.cutter = PreTokens(path)

    def __missing__(self, part: str) -> int:
        n = self[part] = self.cutter.pieces(part)
        return n

    def count(self, texts: list[str]) -> list[int]:
        if len(self) > CACHE_PARTS:
            self.clear()
        whole = map(self.cutter.whole, texts)
        return [sum(self[p] * n for p, n in Counter(self.cutter.of(t)).items()) if w is None else w for t, w in zip(texts, whole)]


class PieceIds(dict):
    """Ids (little-endian unsigned 32-bit bytes) per distinct blank-free part,
    for a vocabulary that drops white space and never joins across it."""

    def __init__(self, path: str):
        import regex

        self.tok = _library(path)
        self.merge = self.tok.model.tokenize
        self.special = _specials(self.tok)
        self.cut = regex.compile(WORD_PATTERN).findall

    def _library_ids(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        got = self.get(piece)
        if got is None:
            got = self[piece] = array("I", [t.id for t in self.merge(_stand_ins(piece))]).tobytes()
        return got

    def __missing__(self, part: str) -> bytes:
        low = part.lower()
        got = self[part] = self._piece(low) if low.isalpha() else b"".join(map(self._piece, self.cut(low)))
        return got

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHE_PARTS:
            self.clear()
        return [self._library_ids(t) if _odd(t, self.special) or not unicodedata.is_normalized("NFC", t)
                or not t.isascii() and any(c in t for c in UNEVEN_CASE) else b"".join(map(self.__getitem__, t.split())) for t in texts]


def distinct_parts(docs: DataFrame, path: str) -> DataFrame:
    """``(part, docs)``: every distinct pre-token of ``(text)`` and the number
    of documents that hold it; batches are counted before the shuffle."""
    def run(batch: pa.RecordBatch):
        cutter = process_cache(("pre-tokens", path), lambda: PreTokens(path))
        found: Counter = Counter()
        for t in batch.column(0).to_pylist():
            if t and cutter.special_free(t):
                found.update(set(cutter.of(t)))
        return list(found), list(found.values())

    return map_batches(docs.select("text"), run, "part string, docs bigint", 1024).groupBy("part").agg(F.sum("docs").alias("docs"))


def piece_counts(parts: DataFrame, path: str) -> DataFrame:
    """``(part, docs, pieces)`` of ``(part, docs)``: each distinct pre-token is encoded once."""
    def run(batch: pa.RecordBatch):
        cutter = process_cache(("pre-tokens", path), lambda: PreTokens(path))
        return batch.column(0), batch.column(1), [cutter.pieces(p) for p in batch.column(0).to_pylist()]

    return map_batches(parts, run, "part string, docs bigint, pieces int", 4096)


def common_from(known: DataFrame) -> int:
    """The least power of two so that at most ``COMMON_PARTS`` pre-tokens are in so many documents."""
    sizes = known.groupBy(F.floor(F.log2(F.col("docs") + 0.5)).alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a power
    least, held = 62, 0
    for e, n in sorted(((int(r["e"]), r["n"]) for r in sizes), reverse=True):
        held += n
        if held > COMMON_PARTS:
            break
        least = e
    return 1 << least


def frequencies(docs: DataFrame, path: str, common: dict[str, int]) -> DataFrame:
    """``(row, doc_id, n_bytes, n_common, parts, times)`` of ``(doc_id, text)``:
    the pieces of a document's common pre-tokens, and its other distinct
    pre-tokens with how often each stands in it.  The count of a text that
    must not be cut is all in ``n_common``."""
    def run(batch: pa.RecordBatch):
        cutter = process_cache(("pre-tokens", path), lambda: PreTokens(path))
        n_bytes, n_common, parts, times = [], [], [], []
        for t in batch.column(2).to_pylist():
            t = t or ""
            n_bytes.append(len(t.encode()))
            whole = cutter.whole(t)
            found = Counter() if whole is not None else Counter(cutter.of(t))
            rest = [p for p in found if p not in common]
            n_common.append((whole or 0) + sum(n * common[p] for p, n in found.items() if p in common))
            parts.append(rest), times.append([found[p] for p in rest])
        return batch.column(0), batch.column(1), n_bytes, n_common, parts, times

    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return map_batches(src, run, f"row bigint, doc_id {kind}, n_bytes bigint, n_common bigint, parts array<string>, times array<int>")


def count_tokens(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_bytes, n_tokens, over_limit)``.

    Each distinct pre-token of the table is encoded once, and a join with the
    frequencies of the documents gives the sums; no id list is built.  At most
    ``COMMON_PARTS`` pre-tokens, those of the most documents, go to the tasks
    and are joined there, so no very common one is a hot key of the shuffle
    that joins the others.  A null text counts as empty (0 bytes, 0 tokens);
    null and repeated ids, and repeated rows, are kept row by row; other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    ``path`` is a byte-level vocabulary file for the tokenizers library."""
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = written(piece_counts(distinct_parts(src, path), path), "pieces")
    least = common_from(known)
    common = {r["part"]: r["pieces"] for r in known.where(F.col("docs") >= least).select("part", "pieces").collect()}
    counted = written(frequencies(src, path, common), "frequencies")
    held = counted.select("row", F.explode(F.arrays_zip("parts", "times")).alias("x")).select(
        "row", F.col("x.parts").alias("part"), F.col("x.times").alias("times"))
    rare = known.where(F.col("docs") < least).select("part", "pieces")
    sums = held.join(rare, "part").groupBy("row").agg(F.sum(F.col("times").cast("bigint") * F.col("pieces")).alias("n"))
    n = (F.col("n_common") + F.coalesce("n", F.lit(0))).cast("bigint")
    return (counted.select("row", "doc_id", "n_bytes", "n_common").join(sums, "row", "left")
            .select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")))


def token_pieces(docs: DataFrame, path: str, max_len: int = 2048, end_id: int = 0,
                 doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Each document's ids followed by ``end_id``, cut into pieces of at most
    ``max_len``: ``(doc_id, piece, start, length, ids_crc32[, ids])``.  A null
    text is an empty one (its single token is ``end_id``)."""

    end = array("I", [end_id]).tobytes()

    def run(batch: pa.RecordBatch):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        all_ids = process_cache(("ids", path), lambda: PieceIds(path)).ids(texts)
        row, piece, start, length, crc, raw = [], [], [], [], [], []
        for i, b in enumerate(all_ids):
            b += end
            for k, at in enumerate(range(0, len(b), 4 * max_len)):
                part = b[at:at + 4 * max_len]
                row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4)
                crc.append(zlib.crc32(part)), raw.append(part)
        out = [batch.column(0).take(pa.array(row, pa.int64())), piece, start, length, crc]
        return out + [raw] if with_ids else out

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                       + (", ids binary" if with_ids else ""), 256)
