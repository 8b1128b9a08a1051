"""Token counts and packed sequences against the tokenizers library itself."""

import zlib
from array import array
from collections import Counter, defaultdict

import pytest

from roadlens.llm import packing, tokens
from tests.llm.edges import edge_docs, edge_rows, empty_docs

TEXTS = ["", " ", "a", "The cat's on the mat, isn't it?  Yes.", "x  y   z ", "tabs\tand\n\nlines \n end\n", "trailing  ",
         "<|endoftext|>", "a<|endoftext|>b <|startoftext|>. c", "ÀÉ éà ß Straße ΣΑΣ ς", "I'LL don't WE'VE 'S 's", "12345 67,8.9",
         "漢字かな交じり文。", "😀😀 e\u0301 \u0958", "\x1c\x1d \x85 \u2028 \u3000x", "a\x00b", "!!! ... ,,. a., b.. c,.", "İstanbul", "ﬁne ª º ² ½"]


def library(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.tokenizer_path(name))


def test_counts_equal_the_library():
    tok = library("byte_bpe_50k.json")
    got = tokens.PieceCounts(tokens.tokenizer_path("byte_bpe_50k.json")).count(TEXTS)
    assert got == [len(tok.encode(t, add_special_tokens=False)) for t in TEXTS]


def test_ids_equal_the_library():
    tok = library("word_bpe_49k.json")
    got = tokens.PieceIds(tokens.tokenizer_path("word_bpe_49k.json")).ids(TEXTS)
    assert [list(array("I", b)) for b in got] == [tok.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_small_table_of_parts_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 1)
    tok = library("byte_bpe_50k.json")
    counts = tokens.PieceCounts(tokens.tokenizer_path("byte_bpe_50k.json"))
    for t in TEXTS:
        assert counts.count([t]) == [len(tok.encode(t, add_special_tokens=False))]


def test_count_tokens_on_edges(spark):
    tok = library("byte_bpe_50k.json")
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    got = Counter(map(tuple, tokens.count_tokens(edge_docs(spark), path, 512).collect()))
    want = Counter()
    for i, t, *_ in edge_rows():
        n = len(tok.encode(t or "", add_special_tokens=False))
        want[(i, len((t or "").encode()), n, n > 512)] += 1
    assert got == want
    assert tokens.count_tokens(empty_docs(spark), path).count() == 0


def test_packed_documents_round_trip(spark):
    tok = library("word_bpe_49k.json")
    path = tokens.tokenizer_path("word_bpe_49k.json")
    packed = packing.pack_documents(edge_docs(spark), path, capacity=64, with_ids=True)
    rows = packed.collect()
    want = Counter()
    for i, t, *_ in edge_rows():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 64):
            part = array("I", ids[k:k + 64])
            want[(i, k // 64, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for parts in places.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert made == {s: b"".join(b for _, _, b in sorted(p)) for s, p in places.items()}
    assert packing.pack_documents(empty_docs(spark), path).count() == 0


@pytest.mark.parametrize("max_open", [1, 3, 1000])
def test_best_fit_against_a_plain_version(max_open):
    import random
    random.seed(max_open)
    lengths = [random.randint(1, 50) for _ in range(600)]
    bins = packing.OpenBins(50, max_open)
    free, made = {}, 0
    for n in lengths:
        at, offset = bins.place(n)
        fits = [f for f in free.values() if f >= n]
        if fits:
            assert free[at] == min(fits)
            assert offset == 50 - free[at]
            free[at] -= n
        else:
            if len(free) >= max_open:
                fullest = min(free.values())
                gone = [b for b in free if free[b] == fullest and b not in [x for v in bins.bins for x in v]]
                assert len(gone) == 1
                del free[gone[0]]
            assert at == made and offset == 0
            made += 1
            free[at] = 50 - n
        if not free[at]:
            del free[at]
        assert len(free) <= max_open and bins.open == len(free)


def test_packing_is_near_the_lower_bound(spark):
    from pyspark.sql import functions as F
    rows = packing.numbered(spark.range(6000).select((F.pmod(F.xxhash64("id"), F.lit(2000)) + 1).alias("length"), "id"))
    out = packing.pack(rows)
    total = rows.agg(F.sum("length")).first()[0]
    assert out.select("sequence_id").distinct().count() <= 1.04 * total / 2048


SCRIPTS = ["漢字かな交じり文。これは長い文です、12 345。", "مرحبا بالعالم، كيف الحال؟ ١٢٣", "שלום עולם 😀👍🏽 ok", "हिन्दी में लिखा हुआ पाठ", "ไทย ภาษา",
           "한국어 텍스트 mixed with English words", "ȩ́ ö ‍​ zero", " line  sep\x85 x\x1c\x1fy", "𝔘𝔫𝔦 𝟙𝟚 ﷺ Ⅷ ²", "a퟿b \U0010ffff"]


def test_the_join_equals_the_library_in_all_scripts(spark):
    tok, path = library("byte_bpe_50k.json"), tokens.tokenizer_path("byte_bpe_50k.json")
    texts = [*TEXTS, *SCRIPTS, None, " ".join(SCRIPTS) * 40, "the <|endoftext|> " * 30] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokens.count_tokens(docs, path).collect()}
    assert got == {i: (len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False))) for i, t in enumerate(texts)}


@pytest.mark.parametrize("share", [0, 1, 20, 1 << 16])
def test_common_and_rare_parts_add_up(spark, monkeypatch, share):
    monkeypatch.setattr(tokens, "COMMON_PARTS", share)
    tok, path = library("byte_bpe_50k.json"), tokens.tokenizer_path("byte_bpe_50k.json")
    texts = [f"the same word {i} {i % 7} and unlikely{i * 37}" for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, path).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
