"""The queries over texts, against the libraries and against plain Python, over sf0.001 and hard texts."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from veilframe.llm import tiff, token_counts, token_store, trie_bpe
from veilframe.llm.common import Scratch

SF = "/root/testdata/sf0.001"
HARD = ["", " ", "a", "<|endoftext|>x <|startoftext|>", "İstanbul ΑΣ σς", "a\x1cb", "it's 'the", "日本語 テキスト", "x" * 5000, "the " * 3000, "\n\n  end \t", "é́ é", "\x85  ..!!", "1234 5½ ²", None]


def rows(spark):
    random.seed(7)
    bits = ["a", "th", "ing", "é", "'s", "<|endoftext|>", " ", "  ", "\n", "0", "!", "..", "ß", "日", "\x1c", "́", "'re", "the", "\x85"]
    texts = HARD + ["".join(random.choices(bits, k=random.randint(0, 30))) for _ in range(300)]
    hard = spark.createDataFrame([(10_000 + i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (3, "again", "x"), (3, "again", "x")], "doc_id long, text string, ids string")
    return hard.unionByName(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "lang AS ids"))


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_trie_bpe_equals_the_library(spark, word):
    df = rows(spark)
    want = []
    for r in df.collect():
        ids = word.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(word.decode(ids, skip_special_tokens=False).encode())))
    got = [tuple(r) for r in trie_bpe.digests(df, public_tokenizers.path("word_bpe_49k.json")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_library_encoder_equals_the_library(word, monkeypatch):
    monkeypatch.setattr(trie_bpe, "TOGETHER", 7)
    monkeypatch.setattr(trie_bpe, "LIBRARY_WORDS", 500)
    own, g = trie_bpe.LibraryEncoder(public_tokenizers.path("word_bpe_49k.json")), np.random.default_rng(0)
    letters = [chr(i) for i in range(256)] + list("'sstdremvl" * 3)
    for more in ([], list("\u0301\u212bİſ中\u2028\ufb01")):
        texts = ["".join(g.choice(letters + more, g.integers(0, 60))) for _ in range(3_000)] + ["<|startoftext|>it's<|endoftext|> 3²", "", " "]
        for k in range(0, len(texts), 500):
            want = [np.array(word.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[k : k + 500]]
            assert list(own.encode_ids(texts[k : k + 500])) == want


def test_trie_bpe_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", "c", "d")], "doc_id long, text string, ids string, N_tokens string")
    out = trie_bpe.encode(df, public_tokenizers.path("word_bpe_49k.json"))
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    assert out.first().decoded == "a</w> b</w>"
    assert trie_bpe.encode(df.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_spines_forbid_what_merging_would_join():
    model = {"vocab": {s: i for i, s in enumerate(["a", "b", "a</w>", "b</w>", "aa", "ab", "aab", "aa</w>", "ab</w>"])}, "merges": ["a a", "a b", "aa b", "a a</w>", "a b</w>"], "end_of_word_suffix": "</w>"}
    table = trie_bpe.MergeTable(model)
    words = sorted({"".join(w) for n in range(1, 9) for w in __import__("itertools").product("ab", repeat=n)})
    for w, got in zip(words, table.encode_sorted(words), strict=True):
        seq = [table.ids[c] for c in w[:-1]] + [table.ids[w[-1] + "</w>"]]
        while True:
            found = [(table.rank[p], k) for k, p in enumerate(zip(seq, seq[1:], strict=False)) if p in table.rank]
            if not found:
                break
            _, k = min(found)
            seq[k : k + 2] = [next(x for x, p in table.parts.items() if p == (seq[k], seq[k + 1]))]
        assert got == seq, w


def test_token_counts_equal_the_library(spark):
    tok, df = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), rows(spark)
    want = [(r.doc_id, len((r.text or "").encode()), n := len(tok.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in df.collect()]
    got = [tuple(r) for r in token_counts.count(df, public_tokenizers.path("byte_bpe_50k.json")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.count(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_store_round_trip(spark, word):
    df = rows(spark)
    want, start = [], 0
    for r in sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode())):
        ids = [*word.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_store.round_trip(df, public_tokenizers.path("word_bpe_49k.json")).collect()]
    assert sorted(got, key=lambda x: x[1]) == want
    assert token_store.round_trip(df.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_store_reads_only_what_is_asked(spark, tmp_path):
    path = tmp_path / "x.zst"
    docs = [np.arange(5), np.arange(0), np.arange(3_000_000) % 65_000, np.array([7])]
    with open(path, "wb") as out:
        w = token_store.StoreWriter(out, 2)
        for k, d in enumerate(docs):
            w.add(k if k else None, d)
        w.close()
    with open(path, "rb") as f:
        r = token_store.StoreReader(f, path.stat().st_size)
        assert [len(r), r.doc_id(0), r.doc_id(2)] == [4, None, 2]
        assert (r.ids(3) == docs[3]).all() and r.decompressed == 1
        assert (r.ids(2) == docs[2]).all() and r.decompressed == 4
        assert len(r.ids(1)) == 0 and (r.ids(0) == docs[0]).all()
    data = bytearray(path.read_bytes())
    data[14] ^= 1
    path.write_bytes(data)
    with open(path, "rb") as f, pytest.raises(Exception):  # noqa: B017 the frame or its checksum
        token_store.StoreReader(f, path.stat().st_size).ids(0)
    import io

    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(token_bytes([np.array([1, 2])]))), read_across_frames=True).read()
    assert whole == struct.pack("<II", 1, 2)


def token_bytes(docs):
    import io

    out = io.BytesIO()
    w = token_store.StoreWriter(out, 4)
    for d in docs:
        w.add(1, d)
    w.close()
    return out.getvalue()


def test_store_reads_wanted_documents(spark):
    df = spark.createDataFrame([(i, f"word{i} " * (i % 5)) for i in range(200)], "doc_id long, text string")
    scratch = Scratch(spark, "t")
    index = token_store.write(df, f"{scratch.root}/s", public_tokenizers.path("word_bpe_49k.json"), scratch)
    got = token_store.read(index, spark.createDataFrame([(5,), (77,), (999,)], "doc_id long")).collect()
    every = {r.doc_id: r for r in token_store.read(index).collect()}
    assert sorted(r.doc_id for r in got) == [5, 77] and all(every[r.doc_id] == r for r in got)


def test_media_of_documents(spark):
    df = rows(spark)
    got = {(r.doc_id, r.n_bytes, r.payload_sha256): r for r in tiff.document_media(df).collect()}
    for r in df.collect():
        data = (r.text or "").encode()
        full = data + b" " * (max(192, -(-len(data) // 192) * 192) - len(data))
        x = got[r.doc_id, len(data), sha(full)]
        assert (x.payload_bytes, x.tail_crc32) == (len(full), zlib.crc32(full[-16:]))


@pytest.mark.parametrize("coding", ["none", "packbits", "lzw", "deflate"])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("tile", [None, 16])
@pytest.mark.parametrize("predictor", [False, True])
def test_tiff_round_trip(coding, order, tile, predictor):
    g = np.random.default_rng(1)
    pages = [g.integers(0, 4, (50, 33, 3), np.uint8), np.zeros((1, 1, 1), np.uint8), g.integers(0, 256, (200, 70, 1), np.uint8), np.repeat(g.integers(0, 9, (40, 5, 3), np.uint8), 20, 1)]
    data = tiff.write_pages(pages, coding, predictor, 7, tile, order)
    got = list(tiff.read_pages(data))
    assert [p.pixels for p in got] == [p.tobytes() for p in pages]
    assert [(p.height, p.width, p.samples) for p in got] == [p.shape for p in pages]


def test_tiff_lzw_long_and_packbits_known():
    g = np.random.default_rng(2)
    for data in (b"", b"a", bytes(100_000), g.integers(0, 256, 60_000, np.uint8).tobytes(), b"abcabc" * 5000):
        assert tiff.unpack_lzw(tiff.pack_lzw(data), len(data)) == data
        assert tiff.unpack_bits(tiff.pack_bits(data), len(data)) == data
    # the example in the format's description
    assert tiff.unpack_bits(bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA"), 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")


def test_tiff_damaged_files_give_an_error_row(spark):
    good = tiff.write_pages([np.zeros((4, 4, 1), np.uint8)] * 2)
    df = spark.createDataFrame([(1, bytearray(good), "p"), (2, None, "p"), (3, bytearray(b"nonsense"), "p"), (4, bytearray(good[:-20]), "p")], "k int, content binary, pixels string")
    got = sorted((r.k, r.page_no, r.error is None) for r in tiff.explode_pages(df).collect())
    assert got == [(1, 0, True), (1, 1, True), (2, 0, False), (3, 0, False), (4, 0, True), (4, 1, False)]


def tiff_of(pages, order="<"):
    """A file of pages given as their tags and strips, by hand."""
    out, link = bytearray({"<": b"II", ">": b"MM"}[order] + struct.pack(f"{order}HI", 42, 0)), 4
    for tags, strips in pages:
        offsets = []
        for x in strips:
            offsets.append(len(out))
            out += x
        tags = tags | {273: offsets, 279: [len(x) for x in strips]}
        body = b""
        for tag, values in sorted(tags.items()):
            packed = struct.pack(f"{order}{len(values)}I", *values)
            if len(packed) > 4:
                at, packed = len(out), struct.pack(f"{order}I", len(out))
                out += struct.pack(f"{order}{len(values)}I", *values)
            body += struct.pack(f"{order}HHI", tag, 4, len(values)) + packed
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(tags)) + body
        link = len(out)
        out += bytes(4)
    return bytes(out)


@pytest.mark.parametrize("order", ["<", ">"])
def test_tiff_other_samples_and_pages_after_unsupported_ones(spark, order):
    g = np.random.default_rng(3)
    gray, ink, deep, planar = g.integers(0, 256, (3, 5, 1), np.uint8), g.integers(0, 2, (4, 11, 1), np.uint8), g.integers(0, 65536, (2, 3, 1)).astype("<u2"), g.integers(0, 256, (2, 4, 3), np.uint8)
    size = lambda x, **more: {256: [x.shape[1]], 257: [x.shape[0]], 277: [x.shape[2]], 278: [x.shape[0]], **{int(k[1:]): v for k, v in more.items()}}
    diff = np.diff(deep, axis=1, prepend=np.zeros_like(deep[:, :1]))
    pages = [
        (size(gray, t258=[8], t259=[1]), [gray.tobytes()]),
        (size(ink, t258=[1], t259=[32773]), [tiff.pack_bits(np.packbits(ink[:, :, 0], axis=1).tobytes())]),
        (size(gray, t258=[4], t259=[1]), [b"xxxxxxxxx"]),
        (size(deep, t258=[16], t259=[1], t317=[2]), [diff.astype(f"{order}u2").tobytes()]),
        (size(gray, t258=[8], t259=[8]), [b"not deflate"]),
        (size(planar, t258=[8, 8, 8], t259=[1], t284=[2]), [planar[:, :, c].tobytes() for c in range(3)]),
    ]
    df = spark.createDataFrame([(1, bytearray(tiff_of(pages, order)), "b")], "k int, content binary, bits string")
    got = sorted(tiff.explode_pages(df).collect(), key=lambda r: r.page_no)
    assert [(r.page_no, r.bits, r.error is None) for r in got] == [(0, 8, True), (1, 1, True), (2, None, False), (3, 16, True), (4, None, False), (5, 8, True)]
    assert [bytes(got[k].pixels) for k in (0, 1, 3, 5)] == [gray.tobytes(), (ink * 255).tobytes(), deep.tobytes(), planar.tobytes()]
