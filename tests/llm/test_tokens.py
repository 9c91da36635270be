"""Token files, pieces and the flat-array helpers beside the libraries and brute force."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kindred.llm import blocks, pieces, token_files, wavelet
from tests.llm import brute

ODD = ["", " ", "  a", "a  b", "a b ", "x\n y", "it's  we'll\t\tgo", "日本 語 😀é", "<|endoftext|> b <|endoftext|>",
       "word " * 2000, "a b c　d", "éèê çà\r\n ok", "▁a ▁"]


def test_words_of_flat_arrays():
    texts = [*ODD, "A-b.c9 ÄÖ", "z"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([*texts, None])})
    for limit in (1, 50, 1 << 20):
        seen, hashes = [], {}
        for part, data, offsets in blocks.slices(iter([batch, batch.slice(0, 0)]), limit=limit):
            for of_words, find in ((blocks.UNSPACED, brute.WORDS.findall), (blocks.ALPHANUMERIC, brute.normal_words)):
                starts, ends, first = blocks.spans(data, offsets, of_words)
                raw = data.tobytes()
                words = [raw[s:e] for s, e in zip(starts, ends, strict=True)]
                if find is brute.normal_words:
                    words = [w.lower() for w in words]
                for i, text in enumerate(part.column("text").to_pylist()):
                    assert words[first[i]:first[i + 1]] == [w.encode() for w in find(text or "")]
                fold = blocks.LOWER if find is brute.normal_words else blocks.EXACT
                for w, h in zip(words, blocks.word_hashes(data, starts, ends, fold), strict=True):
                    assert hashes.setdefault(w, h) == h
            seen += part.column("text").to_pylist()
        assert seen == [*texts, None]
        assert len(set(hashes.values())) == len(hashes)


def test_wavelet_rank_and_restore():
    values = np.random.default_rng(1).integers(0, 11, 3000)
    matrix = wavelet.WaveletMatrix(values, 4)
    every = np.arange(11)
    base = matrix.descend(every, np.zeros(11, np.int64))
    for at in (0, 1, 63, 64, 65, 2999, 3000):
        counts = matrix.descend(every, np.full(11, at)) - base
        assert counts.tolist() == np.bincount(values[:at], minlength=11).tolist()
    assert (wavelet.restore(list(wavelet.planes(values, 4)), 3000) == values).all()


def test_backward_search_counts_occurrences():
    text = np.append(np.random.default_rng(2).integers(1, 5, 499), 0)
    index, n = wavelet.FMIndex(text, 6), 500
    for start in range(0, 490, 7):
        low, high = np.array([0]), np.array([n])
        for step in range(5, -1, -1):
            low, high = index.extend(text[[start + step]], low, high)
        want = [i for i in range(n - 5) if (text[i:i + 6] == text[start:start + 6]).all()]
        assert sorted(index.suffixes[low[0]:high[0]]) == want


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = token_files.Encoder(path), Tokenizer.from_file(path)
    for texts in (ODD, ODD[::-1]):
        for text, raw in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(raw, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 100, 70_000])
def test_token_file(n, monkeypatch):
    pick = np.random.default_rng(n)
    ids = pick.integers(0, 300, n).astype(np.uint32)
    ends = np.array(sorted(pick.integers(0, n + 1, 3)) + [n])
    held = token_files.TokenFile(io.BytesIO(token_files.pack(ids, np.arange(4), ends)))
    assert held.ids().tolist() == ids.tolist() and held.ends.tolist() == ends.tolist()
    for at in pick.integers(0, max(n, 1), 20) if n else []:
        assert held.access(int(at)) == ids[at]
        assert held.rank(int(ids[at]), int(at)) == (ids[:at] == ids[at]).sum()
    for token in (0, 7, 299, 100_000):
        where = np.flatnonzero(ids == token)
        assert held.count(token) == len(where) and held.occurrences(token).tolist() == where.tolist()
        assert not len(where) or held.select(token, len(where) - 1) == where[-1]


def test_round_trip_of_token_files(spark):
    pick = random.Random(1)
    rows = [(pick.randint(0, 10**9), t) for t in [*ODD, None] * 3]
    rows.append((None, "first"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = token_files.round_trip(docs, path, shard_tokens=40).collect()
    library, start, want = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == want
    assert len({r.file for r in got}) > 4
    assert token_files.round_trip(docs.limit(0), path).collect() == []


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(public_tokenizers.path("piece_bpe_32k.model"))


def splits(word, vocabulary):
    if not word:
        return [(0.0, [])]
    found = []
    for end in range(1, len(word) + 1):
        head = word[:end]
        if head in vocabulary.scores:
            cost = vocabulary.scores[head]
        elif end == 1:
            cost = min(vocabulary.scores.values()) - pieces.UNKNOWN_PENALTY
        else:
            continue
        found += [(cost + rest, [head, *more]) for rest, more in splits(word[end:], vocabulary)]
    return found


def test_pieces_are_the_best_split(codec):
    words = ["▁then", "▁there", "▁the", "▁▁a", "▁日本", "▁café", "▁x\ty", "▁"]
    found = pieces.encode_words(words, codec.vocabulary)
    texts = codec.vocabulary.texts
    for word in words:
        best = max(total for total, _ in splits(word, codec.vocabulary))
        spelled = b"".join(texts[i] for i in found[word]).decode()
        assert spelled == word.replace("▁", " ")
        ids = codec.vocabulary.ids
        assert any(total == best and [ids[p] for p in parts if p in ids] == [i for i in found[word] if i in ids.values()]
                   for total, parts in splits(word, codec.vocabulary))


def test_shared_prefixes_change_nothing(codec):
    words = sorted({"▁" + w for t in ODD for w in t.split()})
    together = pieces.encode_words(words, codec.vocabulary)
    assert together == {w: pieces.encode_words([w], codec.vocabulary)[w] for w in words}


def test_pieces_round_trip(spark, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 2)
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    got = pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(rows) and all(r.restored for r in got)
    assert {r.doc_id: r.n_pieces for r in got}[0] == 0
    assert pieces.round_trip(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).collect() == []


@pytest.mark.parametrize("kept", [3, 1_500_000])
def test_pieces_of_slices_are_those_of_their_words(codec, monkeypatch, kept):
    """Array look-ups with hashes beside splitting each text into marked words."""
    monkeypatch.setattr(pieces, "KEPT_WORDS", kept)
    texts = [*ODD, None, "▁", "a▁b ▁ c", "  two  blanks ", "x" * 300, "▁▁start", "the then there the", ""]
    for _ in range(2):
        array = pa.array(texts, pa.string())
        data, offsets = blocks.flat(array)
        found, begins, count = codec.encode(data, offsets)
        for i, text in enumerate(texts):
            words = pieces.marked_words(text or "")
            split = pieces.encode_words(words, codec.vocabulary)
            assert found[begins[i]:begins[i + 1]].tolist() == [p for w in words for p in split[w]]
            assert count[i] == len(words)
        spelled = codec.decode(found, begins).to_pylist()
        assert spelled == [(t or "").replace("▁", " ") for t in texts]
        assert len(codec.hashes) <= max(kept, len({w for t in texts for w in pieces.marked_words(t or "")}))
    assert codec.encode(np.zeros(0, np.uint8), np.zeros(1, np.int64))[0].tolist() == []


def test_marked_words_are_made_from_their_parts():
    """A word with marks or a line break is not given to the library once its parts are known."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = token_files.Encoder(path), Tokenizer.from_file(path)
    plain = ["one two Éric straße x² 日本", "a, b\nÉric c### d!?"]
    marked = ["z one, two### Éric.\nÉric!? straße'\nÉric x². 日本... it's don't.\nwe'll a--b <|endoftext|>, one.\n\nÉric one.\n",
              "", " ", "one,", "one.\nÉric one.\nÉric", "\tone two, ", "x  one, two,"]
    encoder.encode(plain)
    given = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return library.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counted()
    for texts in (marked, marked[::-1], [""]):
        for text, raw in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(raw, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
    given.clear()
    encoder.encode(["z one!? Éric###\nÉric, two.\nÉric."])
    assert not any("one" in t or "two" in t for t in given)
