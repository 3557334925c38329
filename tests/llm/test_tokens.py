"""Token counts, byte-level BPE, token files: against the libraries, and what odd rows give."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from turnweave.llm import byte_bpe, token_counts, token_file
from turnweave.llm.common import shared_dir, space_chunks

SCHEMA = "doc_id long, text string, n_tokens string, key string"
ALPHABET = "a▁ \n\t é½ﬁ２b<s>/\x00#本😀\r'1\x1c\x85  "


def odd_texts() -> list[str]:
    rng = random.Random(5)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return made + ["a" * k for k in range(40)] + ["ab" * 2000, "=" * 5000, "x y" * 3000, " ", "  ", "\n", "<|endoftext|> a", "it's we'll I'M", " lead", "trail "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(odd_texts())]
    rows += [(None, "no id", "x", "y"), (7000, None, "x", "y"), (7001, "", "x", "y"), (7002, "same", "x", "y"), (7002, "same", "x", "y")]
    return spark.createDataFrame(rows, SCHEMA)


def same(got, docs, of) -> None:
    want = sorted(((r.doc_id, *of(r.text or "")) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_counts_are_the_library_s(docs):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)

    def of(t):
        n = len(library.encode(t))
        return len(t.encode()), n, n > 100

    same(token_counts.count_tokens(docs, path, limit=100), docs, of)


def test_counts_with_a_tiny_cache():
    counter = token_counts.PieceCounter(P.path("piece_bpe_32k.model"), {}, limit=3)
    assert [counter.count(t) for t in odd_texts()] == [len(counter.library.encode(t)) for t in odd_texts()]


def test_counts_of_an_empty_table(spark, docs):
    assert token_counts.count_tokens(docs.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_frequent_pretokens_are_those_of_all_rows(spark):
    docs = spark.range(12_000).selectExpr("concat('all w', id, if(id % 2 = 0, ' twice', '')) as text")
    entries = lambda size: set(token_counts.frequent_table(docs, "text", P.path("piece_bpe_32k.model"), size)[0].decode().split("\x00"))
    assert entries(12_002) == {"all", "twice", *(f"w{i}" for i in range(12_000))}
    assert entries(12_001) == {"all", "twice"}


def test_pretoken_numbers_with_a_tiny_tally(docs):
    want = Counter(s for r in docs.collect() if r.text is not None for s in token_counts.segments(r.text) if 0 < len(s) <= 64 and "\x00" not in s)
    assert {r.segment: r.n for r in token_counts.pretoken_numbers(docs, "text", 3).collect()} == want


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_tiktoken_s(docs, tiktoken_encoding):
    def of(t):
        ids = tiktoken_encoding.encode_ordinary(t)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()

    same(byte_bpe.encode_decode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN), docs, of)


def test_bpe_ids_decode(docs):
    bpe = byte_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    out = byte_bpe.encode_decode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, with_ids=True).where("doc_id < 100").collect()
    texts = odd_texts()
    assert all(bpe.decode(r.ids).decode() == texts[r.doc_id] for r in out) and len(out) == 100


def test_bpe_of_a_very_long_pre_token(tiktoken_encoding):
    rng = random.Random(3)
    word = "".join(rng.choice("abcetrionshlyd") for _ in range(60_000))
    bpe = byte_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert bpe.encode(word) == tiktoken_encoding.encode_ordinary(word)
    assert bpe.encode("z" * 30_001) == tiktoken_encoding.encode_ordinary("z" * 30_001)


def test_bitmap_finds_the_lowest():
    rng, marks, have = random.Random(1), byte_bpe.RankBitmap(60_000), set()
    assert marks.first() == -1
    for _ in range(3000):
        r = rng.randrange(60_000)
        if r in have or rng.random() < 0.3 and have:
            r = min(have) if r not in have else r
            marks.remove(r)
            have.discard(r)
        else:
            marks.add(r)
            have.add(r)
        assert marks.first() == min(have, default=-1)


def test_chunks_join_to_the_text():
    assert all(" ".join(space_chunks(t)) == t for t in odd_texts())


def test_directly_addressable_codes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 511, 512, 513, 5000):
        ids = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        lengths = [n // 3, 0, n - n // 3]
        file = token_file.TokenFile(b"".join(token_file.dump([5, None, 7], lengths, ids)))
        assert file.tokens(0, n).tolist() == ids.tolist()
        assert [file.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
        assert file.tokens(n // 2, n).tolist() == ids[n // 2 :].tolist()
        assert file.document(0).tolist() == ids[: n // 3].tolist() and len(file.document(1)) == 0
    with pytest.raises(ValueError, match="token file"):
        token_file.TokenFile(b"something else")


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id != 7002]
    docs = docs.where("doc_id is null or doc_id <> 7002")
    want, start = {}, 0
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want[k] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for size in (1 << 23, 50):
        manifest = token_file.write_tokens(docs, shared_dir(spark, "t"), P.path("byte_bpe_50k.json"), 2, file_tokens=size)
        got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_file.read_tokens(manifest).collect()}
        assert got == want
    assert token_file.token_archive(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_token_files_with_repeated_keys(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (0, "first")], "doc_id long, text string")
    got = sorted((r.doc_id, r.start) for r in token_file.token_archive(docs, P.path("byte_bpe_50k.json")).collect())
    assert got == [(0, 0), (1, 2), (1, 4)]


def test_one_token_without_the_file(tmp_path):
    """Of a file of 600 KB a token costs the header and some hundred bytes a level."""

    ids = np.random.default_rng(1).integers(0, 1 << 17, 300_000).astype(np.uint32)
    path = tmp_path / "a.dac"
    path.write_bytes(b"".join(token_file.dump([1, 2], [100_000, 200_000], ids)))
    assert path.stat().st_size > 500_000

    class Counted:
        def __init__(self, f):
            self.f, self.n = f, 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            self.n += n
            return self.f.read(n)

    with open(path, "rb") as f:
        source = Counted(f)
        file = token_file.TokenFile(source)
        assert [file.token(i) for i in (0, 511, 512, 299_999)] == ids[[0, 511, 512, 299_999]].tolist()
        assert source.n < 5_000
        assert (file.document(1) == ids[100_000:]).all()
