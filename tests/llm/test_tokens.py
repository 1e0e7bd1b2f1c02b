"""Encoders, counts, packing and languages against libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import byte_bpe, language, packing, token_count
from tallyhouse.llm.common import Memo

from .conftest import HARD

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
PIECES = P.path("piece_bpe_32k.model")
TRICKY = st.text(st.sampled_from(" \n\t\r　  abcdé'sTlre012!?.-日本\x1c\x85|<>🙂"), max_size=60)


def read(path):
    with open(path, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def texts(sf_dir):
    column = pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"]
    return [t or "" for t in column.to_pylist()]


@pytest.fixture(scope="module")
def bpe():
    ranks = byte_bpe.load_ranks(read(RANKS))
    return (byte_bpe.Encoder(ranks, P.PATTERN), tiktoken.Encoding(
        "t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_rank_queue_equals_tiktoken(bpe, texts):
    own, theirs = bpe
    for text in texts[:300] + ["a" * 5001, "ab" * 3000 + "é" * 999]:
        assert ids_of(own.encode(text)) == theirs.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(TRICKY)
def test_rank_queue_on_any_text(text):
    ranks = _RANKS or _RANKS.update(byte_bpe.load_ranks(read(RANKS))) or _RANKS
    own = _ENCODERS.setdefault("own", byte_bpe.Encoder(ranks, P.PATTERN))
    theirs = _ENCODERS.setdefault("t", tiktoken.Encoding(
        "t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    assert ids_of(own.encode(text)) == theirs.encode_ordinary(text)


_RANKS: dict = {}
_ENCODERS: dict = {}


def test_encode_decode_and_hard_rows(hard, empty):
    ids = byte_bpe.encode(hard, RANKS, P.PATTERN)
    back = byte_bpe.decode(ids, RANKS).collect()
    assert sorted(bytes(r.decoded).decode() for r in back) == sorted(t or "" for _, t in HARD)
    rows = byte_bpe.digest(byte_bpe.round_trip(hard, RANKS, P.PATTERN)).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(HARD)
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (1, 2)} == {
        (0, nothing, nothing)}
    assert byte_bpe.round_trip(empty, RANKS, P.PATTERN).count() == 0


def test_op2_equals_tiktoken_on_the_table(spark, sf_dir, bpe, texts):
    from tallyhouse.llm.queries import QUERIES

    ids = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id"])["doc_id"].to_pylist()
    got = {r.doc_id: r for r in QUERIES["op2_byte_bpe"](spark, sf_dir).collect()}
    assert len(got) == len(ids)
    for i, text in zip(ids, texts):
        want = bpe[1].encode_ordinary(text)
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_memo_is_bounded():
    memo = Memo(len, limit=10, longest=5)
    assert [memo["x" * (i % 7)] for i in range(50)] == [i % 7 for i in range(50)]
    for i in range(100):
        keys = {f"{j}" for j in range(i, i + 8)} | {"long key"}
        found = memo.with_all(keys, lambda new: {k: len(k) for k in new})
        assert all(found[k] == len(k) for k in keys) and len(memo) <= 20
        assert len(memo.older) <= 20


# --- unigram counts ---------------------------------------------------------------------

def brute_count(text, scores):
    """Tokens of the best segmentation of a whole text at once; ties to the fewest."""
    text, low = text.replace(" ", token_count.MARK), min(scores.values()) - 10
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        c = text[end - 1]
        own = (scores[c], 1) if c in scores else (low, len(c.encode()))
        options = [(best[end - 1][0] + own[0], best[end - 1][1] + own[1])]
        options += [(best[s][0] + scores[text[s:end]], best[s][1] + 1)
                    for s in range(max(0, end - 16), end - 1) if text[s:end] in scores]
        best.append(max(options, key=lambda x: (x[0], -x[1])))
    return best[-1][1]


def test_trie_counts_equal_whole_text(texts):
    scores = token_count.piece_scores(read(PIECES))
    counter = token_count.Counter(scores)
    rng = random.Random(5)
    sample = [t[:300] for t in texts[:60]] + ["", " ", "   a  b\n\n c ", "🙂 日本 x" * 9] + [
        "".join(rng.choice(" ab\néthe") for _ in range(50)) for _ in range(60)]
    assert [n for n, _ in counter.texts(sample)] == [brute_count(t, scores) for t in sample]


def test_shared_prefixes_are_computed_once():
    calls = []

    class Scores(dict):
        def get(self, key, default=None):
            calls.append(key)
            return super().get(key, default)

    counter = token_count.Counter({"a": -1.0, "b": -1.0, "ab": -1.5})
    counter.scores = Scores(counter.scores)
    assert counter.count(["aab", "aaba", "aabb", "aab"]) == {"aab": 2, "aaba": 3, "aabb": 3}
    assert len(calls) == 9  # 1 + 2 + 2 for aab, then 2 for each new last letter


def test_token_count_hard_rows(hard, empty):
    rows = token_count.token_counts(hard, PIECES).collect()
    assert len(rows) == len(HARD)
    assert {(r.n_tokens, r.n_pre_tokens) for r in rows if r.doc_id in (1, 2)} == {(0, 0)}
    assert token_count.token_counts(empty, PIECES).count() == 0


def test_pre_tokens_share_a_queue():
    """Many pre-tokens together give what each gives alone, and what the library gives."""
    ranks = byte_bpe.load_ranks(read(RANKS))
    own = byte_bpe.Encoder(ranks, P.PATTERN)
    rng = random.Random(5)
    pieces = list({bytes(rng.choice(b"aabbethino s\x00\xc3\xa9") for _ in range(rng.randint(1, 40)))
                   for _ in range(2000)} | {b"a" * n for n in (2, 3, 7, 500)} | {b"ab" * 300})
    theirs = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    together = own.merge_all(pieces)
    for piece in pieces:
        assert together[piece] == own.merge(piece)
        assert ids_of(together[piece]) == theirs._encode_single_piece(piece)


# --- packing ------------------------------------------------------------------------------

def test_file_ids_equal_the_library(texts):
    library = Tokenizer.from_file(JSON)
    own = packing.FileEncoder(read(JSON))
    rng = random.Random(1)
    letters = " \n\t\r　  abcdé'sTlre012!?.-日本\x1c\x85<|endoftext|>"
    sample = texts[:200] + ["<|endoftext|> a", "", "\n\n a\n"] + [
        "".join(rng.choice(letters) for _ in range(30)) for _ in range(3000)]
    sample += [t.decode(errors="ignore") for t in packing.ranks_of(read(JSON))]
    want = [e.ids for e in library.encode_batch(sample, add_special_tokens=False)]
    assert [ids_of(x) for x in own.encode(sample)] == want


def test_added_tokens_are_cut_out_first():
    library, own = Tokenizer.from_file(JSON), packing.FileEncoder(read(JSON))
    assert own.added
    sample = []
    for mark in own.added:
        sample += [f"a {mark} b", mark, f"{mark} a", f"a{mark}", mark * 3, f"x{mark}{mark} \n{mark}y",
                   mark[:-1], f"{mark[1:]}{mark}", f"it's {mark}'s"]
    want = [e.ids for e in library.encode_batch(sample, add_special_tokens=False)]
    assert [ids_of(x) for x in own.encode(sample)] == want
    assert ids_of(own.encode([f"a {next(iter(own.added))} b"])[0]) == [64, 220, 50256, 275]


def test_long_runs_of_white_space(monkeypatch):
    """A million characters of it, which tiktoken cannot take if something follows."""
    library, own = Tokenizer.from_file(JSON), packing.FileEncoder(read(JSON))
    piece = own.tokenizer._encode_single_piece
    run = " " * 1_100_000
    assert ids_of(own.encode([run + " a"])[0]) == [*piece(run), *piece(" a")]
    monkeypatch.setattr(packing, "LONG", 10)  # short texts are cut like long ones
    sample = [f"{a}{space * n}{b}" for a in ("", "a", "a.") for b in ("", "b", "!", " c  d")
              for space in (" ", "\n", "\n ", "\u3000\x85") for n in (31, 32, 33, 63, 64, 65, 66, 200)]
    want = [e.ids for e in library.encode_batch(sample, add_special_tokens=False)]
    assert [ids_of(x) for x in own.encode(sample)] == want


def test_texts_are_encoded_whole():
    """Not word by word: each is one call, and no words are kept."""
    own, calls = packing.FileEncoder(read(JSON)), []

    class Seen:
        def encode_ordinary(self, text):
            calls.append(text)
            return [1]

    own.tokenizer = Seen()
    texts = ["a b  c\n\nd's", "", "e <|endoftext|> f"]
    end = own.added["<|endoftext|>"]
    assert [ids_of(x) for x in own.encode(texts)] == [[1], [1], [1, end, 1]]
    assert calls == ["a b  c\n\nd's", "", "e ", " f"]


def check_packed(rows, size):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_op6_on_the_table(spark, sf_dir, texts):
    from tallyhouse.llm.queries import QUERIES

    rows = QUERIES["op6_packing"](spark, sf_dir).collect()
    bins = check_packed(rows, 2048)
    total = sum(r.length for r in rows)
    assert bins <= 1.01 * -(-total // 2048)
    library = Tokenizer.from_file(JSON)
    ids = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id"])["doc_id"].to_pylist()
    by = {}
    for r in sorted(rows, key=lambda r: r.piece):
        by.setdefault(r.doc_id, []).append(r)
    assert len(by) == len(ids)
    for i, text in zip(ids, texts):
        want = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for k, r in enumerate(by[i]):
            part = want[at:at + r.length].tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part))
            at += r.length
        assert at == len(want) and (len(by[i]) == 1) == (len(want) <= 2048)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_local_search_never_loses_pieces(lengths):
    bins = packing.Bins(50)
    bins.best_fit(lengths)
    before, squares = len(bins.items), sum(f * f for f in bins.fill)
    bins.improve(lengths)
    assert sorted(i for b in bins.items for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) == f <= 50 for b, f in zip(bins.items, bins.fill))
    assert sum(bool(b) for b in bins.items) <= before and sum(f * f for f in bins.fill) >= squares


def test_local_search_empties_bins():
    rng = random.Random(2)
    lengths = [rng.randint(600, 760) for _ in range(3000)]
    bins = packing.Bins(2048)
    bins.best_fit(lengths)
    before = len(bins.items)
    bins.improve(lengths)
    assert sum(bool(b) for b in bins.items) < 0.96 * before


def test_packing_hard_rows(hard, empty, documents):
    rows = packing.pack(packing.pieces(hard, JSON, 64), 64).collect()
    check_packed(rows, 64)
    assert [(r.length, r.ids_crc32) for r in rows if r.doc_id == 1] == [(1, zlib.crc32(bytes(4)))]
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert packing.pack(packing.pieces(empty, JSON)).count() == 0
    with_ids = packing.pieces(documents([(1, "a b c " * 50)]), JSON, 64, ids=True).collect()
    assert all(len(r.ids) == r.length for r in with_ids)


# --- languages ----------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    pieces = {"a": 0, "b": 1, "ab": 2, "ba": 3}
    table = np.array([[0.1], [0.2], [0.3], [0.4], [1e-7], [0.0]])
    lattice = language.Lattice(pieces)
    found = lattice.log_probability(["aba", "x"], table)
    assert np.isclose(np.exp(found["aba"][0]), 0.1 * 0.2 * 0.1 + 0.3 * 0.1 + 0.1 * 0.4)
    assert np.isclose(np.exp(found["x"][0]), 1e-7)
    uses = lattice.expected({"aba": 2.0}, table)
    total = 0.1 * 0.2 * 0.1 + 0.3 * 0.1 + 0.1 * 0.4
    assert np.isclose(uses[2], 2 * 0.03 / total) and np.isclose(uses[3], 2 * 0.04 / total)


def brute_forward(word, pieces, table):
    """Sum over all segmentations, by trying every first piece."""
    if not word:
        return np.ones(table.shape[1])
    total = np.zeros(table.shape[1])
    for k in range(1, len(word) + 1):
        row = pieces.get(word[:k], len(pieces) if k == 1 else None)
        if row is not None:
            total += table[row] * brute_forward(word[k:], pieces, table)
    return total


def test_posteriors_against_brute_force():
    """Words of one and of several blocks, repeated words, priors and ties."""
    pieces = language.vocabulary(read(PIECES))
    rng = np.random.Generator(np.random.PCG64(3))
    table = rng.random((len(pieces) + 2, 3)) / len(pieces)
    table[-2], table[-1] = language.UNKNOWN, 0.0
    prior = np.log(np.array([0.5, 0.3, 0.2]))
    scorer = language.Scorer(read(PIECES), ["a", "b", "c"], prior, table, limit=4)
    texts = ["the cat sat", "the the hat ½", "ein straßen 東京 ж", "x" * 40, None, "12 _", "cat the"]
    for _ in range(2):  # also when the known words were thrown away
        for text, (lang, score) in zip(texts, scorer.predict(texts)):
            words = [w for w in language.words_of(text or "") if any(map(str.isalpha, w))]
            if not words:
                assert (lang, score) == ("und", 0.0)
                continue
            logs = prior + sum(np.log(brute_forward(b, pieces, table))
                               for w in words for b in language.blocks(w) if len(b) <= 14)
            if all(len(b) <= 14 for w in words for b in language.blocks(w)):
                best = np.exp(logs - logs.max())
                assert lang == "abc"[int(logs.argmax())]
                assert np.isclose(score, best.max() / best.sum())
    even = language.Scorer(read(PIECES), ["a", "b"], np.zeros(2), table[:, [0, 0]])
    assert even.predict(["the cat"]) == [("a", 0.5)]


def test_held_out_accuracy(spark, sf_dir):
    from tallyhouse.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_hard_rows(hard, empty, documents):
    learned = documents([(i, "the cat sat on the mat", "en") for i in range(1, 20)]
                        + [(i, "der hund und die katze", "de") for i in range(20, 40)]
                        + [(50, None, "fr"), (51, "no lang here", None)])
    model = language.learn(learned, PIECES)
    assert model[0] == ["de", "en", "fr"]
    told = {(r.doc_id, r.text): (r.lang_pred, r.score)
            for r in language.identify(hard.select("doc_id", "text"), model, PIECES).collect()}
    assert told[1, None] == told[2, ""] == told[3, " \t\n"] == ("und", 0.0)
    assert told[4, "one two three"][0] in model[0] and len(told) == len(set(HARD))
    new = documents([(1, "die katze und der hund"), (2, "the mat"), (3, "123 _ ½")])
    assert [r.lang_pred for r in language.identify(new, model, PIECES).orderBy("doc_id").collect()
            ] == ["de", "en", "und"]
    # Nothing to learn from: no language, every row undecided.
    assert {r.lang_pred for r in language.predictions(hard.withColumn(
        "lang", F.lit(None).cast("string")), PIECES).collect()} == {"und"}
    assert language.predictions(empty, PIECES).count() == 0
    assert language.drop_unidentified(learned, PIECES).columns == learned.columns
