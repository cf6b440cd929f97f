import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing

PATH = packing.vocabulary_path()


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(st.sampled_from("aAzZ.,'sS \n\t!Éé́1²İΣσς-<|endoftext>\x1c\x85\xa0ßſ")
                        | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_encoder_equals_the_tokenizer(texts):
    got = packing.encoder(PATH).encode(texts)
    plain = Tokenizer.from_file(PATH)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_with_a_small_memory(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE_WORDS", 8)
    r = random.Random(2)
    texts = [" ".join(r.choices(["ab", "cd.", "Ef,", "gh", "i.", "jk", "lm", "no.", "pq"], k=12))
             for _ in range(50)]
    plain, e = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    for t in texts:
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == plain.encode(
            t, add_special_tokens=False).ids
        assert len(e.known) <= 40


def best_fit_by_scan(lengths, size):
    rooms, bins = [], []
    for n in lengths:
        open_ = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if open_:
            bins.append(min(open_)[0])
            rooms[min(open_)[1]] -= n
        else:
            bins.append(size)
            rooms.append(size - n)
    return bins, sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_tree_takes_the_tightest_bin(seed):
    r = random.Random(seed)
    size = r.choice([7, 50, 64, 100])
    lengths = sorted((r.randint(1, size) for _ in range(150)), reverse=True)
    bins, offsets = packing.best_fit(lengths, size)
    rooms, final = best_fit_by_scan(lengths, size)
    assert offsets == [size - room for room in rooms]
    used = {}
    for b, n, o in zip(bins, lengths, offsets):
        assert used.get(b, 0) == o
        used[b] = o + n
    assert sorted(size - u for u in used.values()) == final


def test_pieces_and_sequences(spark, make_docs):
    r = random.Random(5)
    texts = [None, "", "Hello, world."] + ["word " * r.choice([3, 30, 100, 127, 128, 300, 1000])
                                            for _ in range(60)] + ["a b"] * 20
    docs = make_docs(texts).unionByName(make_docs(["twice the id"])).selectExpr("*", "1 AS piece", "2 AS length")
    length = 128
    rows = packing.pack_documents(docs, length=length, group_pieces=30, with_ids=True).collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for i, t in [*enumerate(texts), (0, "twice the id")]:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [packing.CLOSING_ID]
        for p, at in enumerate(range(0, len(ids), length)):
            part = np.array(ids[at:at + length], "<u4").tobytes()
            want.append((i, p, at, len(part) // 4, zlib.crc32(part)))
    assert sorted((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in rows) == sorted(want)
    seqs = {}
    for x in rows:
        seqs.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= length
    least = -(-sum(x.length for x in rows) // length)
    assert len(seqs) <= least + 4  # one partly filled sequence per group, about


def test_ids_come_back(spark, make_docs):
    docs = make_docs(["one two three", "four five", None])
    packed = packing.pack_documents(docs, length=4, with_ids=True)
    seqs = packing.sequences(packed).collect()
    got = sorted(np.frombuffer(b"".join(bytes(s.ids) for s in seqs), "<u4").tolist())
    plain = Tokenizer.from_file(PATH)
    assert got == sorted(sum((plain.encode(t, add_special_tokens=False).ids + [1]
                              for t in ("one two three", "four five", "")), []))


def test_empty_table(spark, make_docs):
    assert packing.pack_documents(make_docs([])).count() == 0


def test_added_tokens_and_other_tokenizers(tmp_path):
    texts = ["a <|EndOfText|> B", "<|ENDOFTEXT|>.", "x<|endoftext|>Y, <|startoftext|> Z", "The  CAT, sat.\n"]
    path = packing.vocabulary_path()

    def plain(name):
        return [Tokenizer.from_file(name).encode(t, add_special_tokens=False).ids for t in texts]

    def ours(name):
        return [np.frombuffer(b, "<u4").tolist() for b in packing.Encoder(name).encode(texts)]

    assert ours(path) == plain(path)
    with open(path, encoding="utf-8") as f:
        other = json.load(f)
    other["normalizer"] = None
    cased = tmp_path / "cased.json"
    cased.write_text(json.dumps(other), encoding="utf-8")
    assert ours(str(cased)) == plain(str(cased)) != plain(path)
