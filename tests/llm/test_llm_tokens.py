"""Token files and byte-level BPE against the public libraries."""

import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from llm_cases import no_docs, odd_docs, odd_texts

from tagloom.llm import bpe, token_files, units
from tagloom.llm.words import LONG, byte_codes, span_hashes, text_bytes, word_spans

public = pytest.importorskip("public_tokenizers")
JSON, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(JSON)
    return made


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def random_texts(n=400):
    rng = random.Random(11)
    return ["".join(rng.choice("abcé ñ\n\t  日😀01,.'<|>  　") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_token_files(spark, tokenizer, tmp_path):
    docs = odd_docs(spark, texts=odd_texts() + random_texts(60))
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, JSON, 2)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    want = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    at = 0
    for row, (_, text) in zip(rows, want):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens, row.ids) == (at, len(ids), ids)
        at += len(ids)
    digests = token_files.token_digests(token_files.read_tokens(spark, path)).orderBy("start").collect()
    assert [r.ids_crc32 for r in digests] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows]


def test_token_files_are_selective(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} " * 40) for i in range(3000)], "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, JSON, 2)
    files = sorted(glob.glob(path + "/*.parquet"))
    reach = -1
    for name in files:
        group = pq.ParquetFile(name).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
        assert columns["doc_id"].statistics.min > reach
        reach = columns["doc_id"].statistics.max
    plan = token_files.read_tokens(spark, path, ["doc_id", "n_tokens"]).where("doc_id = 77")
    text = plan._jdf.queryExecution().toString()
    assert "ids" not in text.split("ReadSchema")[-1] and "EqualTo(doc_id,77)" in text
    assert plan.count() == 1


def test_token_files_empty(spark):
    assert token_files.token_file_digests(no_docs(spark), JSON, 2).count() == 0


@pytest.mark.parametrize("segment", [1 << 21, 40])
def test_pieces_encode_as_whole_texts(tokenizer, monkeypatch, segment):
    monkeypatch.setattr(units, "SEGMENT", segment)
    texts = [t or "" for t in odd_texts() if t is None or len(t) < 5000] + random_texts()
    cache = units.PieceCache(token_files.piece_encoder(JSON))
    data, bounds = text_bytes(pa.array(texts))
    got = [[] for _ in texts]
    for row, _, ids, counts in units.encoded_segments(cache, data, bounds):
        for k, part in enumerate(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []):
            got[row + k] += part.tolist()
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_cache_that_overflows(tokenizer, monkeypatch):
    monkeypatch.setattr(units, "CACHE_ENTRIES", 5)
    cache = units.PieceCache(token_files.piece_encoder(JSON))
    for text in random_texts(30):
        data, bounds = text_bytes(pa.array([text]))
        got = [i for _, _, ids, _ in units.encoded_segments(cache, data, bounds) for i in ids.tolist()]
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_transducer_equals_merging(encoding):
    ranks = bpe.read_ranks(RANKS)
    machine = bpe.Transducer(ranks)
    rng = random.Random(5)
    for _ in range(600):
        piece = bytes(rng.choice(b"abcdefgh tion\xc3\xa9\xe6\x97") for _ in range(rng.randint(1, 25)))
        want = [ranks[t] for t in bpe.merge(piece, ranks)]
        assert machine.encode(piece) == want
        assert list(machine.stream([piece[:3], piece[3:]])) == want


def test_transducer_forgets(monkeypatch):
    monkeypatch.setattr(bpe, "TRANSITIONS", 20)
    machine = bpe.Transducer({bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258})
    assert [machine.encode(p) for p in (b"abcab", b"bcabc", b"xyzxyzab") * 5][-1] == [120, 121, 122, 120, 121, 122, 256]
    assert machine.encode(b"abcbc") == [258, 257]


def test_codec_equals_library(encoding):
    codec = bpe.codec(RANKS, public.PATTERN)
    for text in [*(t or "" for t in odd_texts()), *random_texts()]:
        ids = codec.encode_text(text)
        assert ids == encoding.encode_ordinary(text)
        parts = [np.array(ids[k : k + 3], np.int64) for k in range(0, len(ids), 3)]
        assert "".join(codec.decode_stream(parts)) == text


def test_utf8_stream_in_any_cut():
    text = "aé日😀́z" * 3
    data = text.encode()
    for step in range(1, 7):
        stream = bpe.Utf8Stream()
        assert "".join(stream.feed(data[k : k + step]) for k in range(0, len(data), step)) + stream.close() == text
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xe6\x97") + stream.close() == "a�"


def test_round_trips(spark, encoding):
    docs = odd_docs(spark, texts=odd_texts() + random_texts(60))
    got = {r.doc_id: tuple(r)[1:] for r in bpe.round_trips(docs, RANKS, public.PATTERN).collect()}
    ids = {r.doc_id: r.ids for r in bpe.encode_documents(docs, RANKS, public.PATTERN).collect()}
    for row in docs.collect():
        want = encoding.encode_ordinary(row.text or "")
        assert ids[row.doc_id] == want
        digest = hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id] == (len(want), digest, hashlib.sha256((row.text or "").encode()).hexdigest())
    assert bpe.round_trips(no_docs(spark), RANKS, public.PATTERN).count() == 0


def test_word_hashes_of_long_words():
    codes = byte_codes(b" ")
    long = "y" * (2 * LONG + 17)
    data, bounds = text_bytes(pa.array([f"ab {long} ab", None, long, "ab"]))
    starts, ends, words = word_spans(data, bounds, codes)
    found = span_hashes(data, starts, ends, codes)
    assert words.tolist() == [0, 3, 3, 4, 5]
    assert found[0] == found[2] == found[4] and found[1] == found[3] != found[0]


def thue_morse(swap):
    """Words of 1024 letters whose sums of powers are equal modulo 2**64 for any odd base."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(1024))


def test_word_hashes_differ():
    rng = np.random.default_rng(0)
    words = {thue_morse(0), thue_morse(1), "A", "a", "aa", "a" * 8, "a" * 9, "a" * 16, "a" * LONG, "a" * (LONG + 1), "\x00", "\x00\x00", "é", "ÿ"}
    words |= {"".join(rng.choice(list("ab"), rng.integers(1, 40))) for _ in range(20_000)}
    words = sorted(words)
    for fold in (False, True):
        codes = byte_codes(b" ", fold_case=fold)
        data, bounds = text_bytes(pa.array([" ".join(words), " ".join(words[::-1])]))
        starts, ends, _ = word_spans(data, bounds, codes)
        found = span_hashes(data, starts, ends, codes)
        assert (found[: len(words)] == found[len(words) :][::-1]).all()
        assert len(set(found.tolist())) == len(words) - fold  # A and a are one


SPECIAL = ["hello <|endoftext|> world", "<|endoftext|>", "a  <|endoftext|>\n\nb<|endoftext|><|endoftext|> c ", "<|endoftext|", "x<|endoftext|>y", " <|endoftext|>  "]


def test_added_tokens_are_as_the_library_has_them(spark, tokenizer, tmp_path):
    assert 50256 in tokenizer.encode(SPECIAL[0], add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "t"), JSON, 2)
    got = {r.doc_id: list(r.ids) for r in token_files.read_tokens(spark, str(tmp_path / "t")).collect()}
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(SPECIAL)}


@pytest.mark.parametrize("bits", [0, 3, 12])
def test_pieces_whose_hashes_meet(tokenizer, encoding, monkeypatch, bits):
    whole = units.span_hashes
    monkeypatch.setattr(units, "span_hashes", lambda *a: whole(*a) & np.uint64((1 << bits) - 1))
    monkeypatch.setattr(units, "CACHE_ENTRIES", 40)
    texts = random_texts(40) + SPECIAL[:1] + [thue_morse(0) + " " + thue_morse(1), thue_morse(1) + " " + thue_morse(0)]
    codec = bpe.Codec(RANKS, public.PATTERN)
    for cache, want in (
        (units.PieceCache(token_files.piece_encoder(JSON)), lambda t: tokenizer.encode(t, add_special_tokens=False).ids),
        (codec.cache, encoding.encode_ordinary),
    ):
        for text in texts:
            data, bounds = text_bytes(pa.array([text]))
            assert [i for _, _, ids, _ in units.encoded_segments(cache, data, bounds) for i in ids.tolist()] == want(text)


@pytest.mark.parametrize("kind", ["words", "one", "two", "letters", "wide", "digits", "line"])
def test_a_stream_holds_back_little(kind):
    """Long pieces without a cut: what is held back does not grow with them."""
    rng = np.random.default_rng(1)
    machine = bpe.codec(RANKS, public.PATTERN).transducer
    some = [t.decode("utf-8", "ignore") for t in list(machine.ranks)[300:20_000:7]]
    text = {
        "words": "".join(rng.choice(some, 15_000)), "one": "a" * 100_000, "two": "ab" * 50_000, "letters": "".join(rng.choice(list("abcdefgh"), 100_000)),
        "wide": "日本語" * 11_000, "digits": "".join(rng.choice(list("0123456789"), 100_000)), "line": "=-" * 20_000 + "=" * 60_000,
    }[kind].encode()
    got = list(machine.stream(text[k : k + 1000] for k in range(0, len(text), 1000)))
    longest = max(map(len, machine.ranks))
    assert len(text) >= 60_000 and machine.held <= bpe.LOOK + longest
    whole = pytest.importorskip("tiktoken").Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=machine.ranks, special_tokens={})
    assert got == whole.encode_ordinary(text.decode()) == machine.encode(text)
    first = next(machine.stream([text]))
    assert first == got[0]
