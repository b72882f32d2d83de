import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lamina.llm.bpe import Encoder
from lamina.llm.packing import best_fit, bin_completion, lower_bound, pack
from lamina.llm.queries import tokenizer_file
from lamina.llm.texts import slices

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")
PARTS = ["a", "B", "é", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'t's", "1", "22", "!", "$$", "…", "x", "don't", "<|endoftext|>",
         "\r\n", "s", "t", "re", " "]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(*FILES)


@pytest.mark.parametrize("more", [[], ["日", "🙂", "ʼ", " "]])
def test_ids_are_the_tokenizers(encoder, more):
    rng = random.Random(len(more))
    texts = ["", " ", "\n\n"] + ["".join(rng.choices(PARTS + more, k=rng.randint(0, 25))) for _ in range(1500)]
    got = []
    for part in slices(pa.array(texts, pa.string()), 2000):
        flat, counts = encoder.encode(part)
        got += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_added_tokens_are_those_of_the_file(encoder):
    from tokenizers import Tokenizer

    texts = ["a b", "one<|endoftext|>two", "<|endoftext|>", " <|endoftext|> <|endoftext|>x", "日<|endoftext|>", "<|endoftext", "<|end", ""]
    fresh = Tokenizer.from_file(FILES[0])
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[2] == [50256]
    for made in (encoder, Encoder(FILES[0])):
        got = []
        for part in slices(pa.array(texts, pa.string()), 2000):
            flat, counts = made.encode(part)
            got += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
        assert got == want


def optimum(sizes, capacity):
    """Fewest bins, by trying all."""
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + sizes[k] <= capacity:
                place(k + 1, bins[:i] + [bins[i] + sizes[k]] + bins[i + 1:])
        place(k + 1, [*bins, sizes[k]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


def test_bin_completion_against_all_packings():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([10, 20, 31])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, np.int64)
        found = bin_completion(counts, capacity)
        held = np.zeros(capacity + 1, np.int64)
        for items, copies in found:
            assert sum(s * e for s, e in items) <= capacity
            for s, e in items:
                held[s] += e * copies
        assert (held == counts).all()
        used = sum(c for _, c in found)
        assert lower_bound(counts, capacity) <= optimum(sizes, capacity) == used <= sum(c for _, c in best_fit(counts, capacity))


def test_pieces_and_places(spark, docs, encoder):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["of", "tion", "wörd", "x1"], k=rng.choice([0, 3, 30, 90, 400])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, rows[5][1]), (None, "gone")]
    got = pack(docs(*rows), *FILES, capacity=64, end_id=2, with_ids=True).collect()
    whole = {}
    for r in got:
        whole.setdefault(r["doc_id"], []).append(r)
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for i, text in rows[:-1]:
        pieces = sorted(whole[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        ids = [x for r in pieces for x in r["ids"]]
        assert ids == [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert [r["start"] for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
        assert all(r["length"] == 64 for r in pieces[1:])
    assert set(whole) == {i for i, _ in rows[:-1]}
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    counts = np.bincount([r["length"] for r in got], minlength=65)
    assert lower_bound(counts, 64) <= len(sequences) <= lower_bound(counts, 64) + 1
    assert pack(docs(*rows).limit(0), *FILES).count() == 0


def test_repeated_rows_are_documents_of_their_own(spark, docs):
    got = pack(docs((1, "a b"), (1, "a b")), *FILES).collect()
    assert len(got) == 2 and len({(r["sequence_id"], r["offset"]) for r in got}) == 2
