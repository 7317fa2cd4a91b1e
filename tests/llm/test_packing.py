import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from priceloom.llm import packing
from tests.llm.data import DOCS, documents, prose

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


ODD = [
    None, "", " \n", "It's a test's, don't!! “quoted” ﬁ naïve Ångström ＡＢＣ ÀÉ é ø ß ǅ ŉ ǰ 12.5%,", "İstanbul ΟΔΟΣ a\x1cb c\x85d",
    "<|endoftext|> x <|startoftext|>", "'sword 'tis rock'n'roll it'S \"don't\"", "é ö 日本語テキスト 😀", "... !! a-b--c __x__ #tag @me",
    "and&&& of%%% the*** WORD!! (word) \"word\" 'word' word's", "word " * 30_000,
]


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + [prose(rng, 300, lang) for lang in ("en", "de", "fr") for _ in range(5)]
    encoder = packing.Encoder(public_tokenizers.path(NAME))
    encoder.MOST = 500  # forgets on the way
    for _ in range(2):
        for start in range(0, len(texts), 4):
            part = texts[start : start + 4]
            for text, ids in zip(part, encoder.ids(part), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


def test_spaces_and_spellings_of_all_kinds(tokenizer):
    rng = random.Random(9)
    signs = [*"abé ß ǖ ġ Ġ ā İ Σ ﬁ 日 'sd \x00\x85\xa0\xad\u1680\u180e\u2003\u200b\u2028\u202f\u3000\t\n\r\v\f\x1c\x7f.,-_|09", "e\u0301", "word", "né"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(400)] + [" ", " a ", "\u3000a\xa0"]
    texts += ["“Hello,” one said (“no”): «oui», 5€. ¿qué?", "a.\u200b b|\u0301 c"]
    encoder = packing.Encoder(public_tokenizers.path(NAME))
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert encoder.ids([]) == [] and encoder.ids(["", " "]) == [b"", b""]


def test_a_repeated_chunk_is_looked_up_once(tokenizer):
    asked = defaultdict(int)

    class Known(dict):
        def get(self, chunk):
            asked[chunk] += 1
            return super().get(chunk)

    encoder = packing.Encoder(public_tokenizers.path(NAME))
    encoder._known = Known()
    texts = [f"the word the word, known{n % 3}" for n in range(50)]
    for _ in range(2):
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.ids(texts)] == want
    assert asked["the"] == asked["word"] == asked["known1"] == 2


def test_pieces_and_places(spark, tokenizer):
    rng = random.Random(2)
    texts = ODD + [prose(rng, rng.randint(1, 900)) for _ in range(60)]
    digest = [F.crc32("ids").alias("crc")]
    rows = packing.packed_pieces(documents(spark, texts), NAME, 2048, digest).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want = [(n, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for n, s in enumerate(range(0, len(ids), 2048))]
        assert [(r["piece"], r["start"], r["length"], r["crc"]) for r in sorted(by_doc[i], key=lambda r: r["piece"])] == want
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= 1.05 * sum(r["length"] for r in rows) / 2048 + 1


def test_many_shards_waste_little(spark):
    rng = random.Random(3)
    sizes = [min(2048, int(rng.expovariate(1 / 500)) + 1) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long")
    rows = packing.pack(items, 2048, shard=400).collect()
    assert sorted(r["item"] for r in rows) == list(range(3000))
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], sizes[r["item"]]))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(s for _, s in parts[:n]) for n in range(len(parts))]
        assert sum(s for _, s in parts) <= 2048
    assert len(filled) <= 1.02 * sum(sizes) / 2048 + 2


@pytest.mark.parametrize("capacity", [512, 4096])
def test_other_capacities(spark, capacity):
    rng = random.Random(7)
    sizes = [rng.randint(1, capacity) for _ in range(300)] + [capacity]
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "item long, length long"), capacity).collect()
    assert sorted(r["item"] for r in rows) == list(range(len(sizes)))
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], sizes[r["item"]]))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(s for _, s in parts[:n]) for n in range(len(parts))]
        assert sum(s for _, s in parts) <= capacity


def test_crossover_keeps_every_piece_once():
    rng = random.Random(4)
    size = [rng.randint(1, 2047) for _ in range(400)]
    people = packing.evolve(size, [], 2048, rng, children=0)
    for _ in range(5):
        child = packing.cross(people[0], people[1], size, 2048, rng)
        assert sorted(i for b in child[0] for i in b) == list(range(400))
        assert all(r == 2048 - sum(size[i] for i in b) >= 0 for b, r in zip(*child, strict=True))
    best = packing.evolve(size, people, 2048, rng)[0]
    assert len(best[0]) <= len(people[0][0])


def test_sequences_put_the_ids_together(spark):
    held = spark.createDataFrame([(1, b"aaaa"), (2, b"bbbbcccc"), (3, b"dddd")], "item long, ids binary")
    placed = spark.createDataFrame([(1, 7, 2), (2, 7, 0), (3, 8, 0)], "item long, sequence_id long, offset long")
    found = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(held, placed).collect()}
    assert found == {7: b"bbbbccccaaaa", 8: b"dddd"}


def test_crossover_packs_what_best_fit_does_not():
    """Registered capacity and shard: triples that fill a row exactly, which falling best fit takes apart."""
    rng = random.Random(8)
    size = []
    while len(size) < packing.SHARD - 2:
        a = rng.randint(400, 900)
        b = rng.randint(400, 900)
        size += [a, b, 2048 - a - b]
    alone = packing.evolve(size, [], 2048, random.Random(1), children=0)[0]
    crossed = packing.evolve(size, [], 2048, random.Random(1), children=12)[0]
    assert len(alone[0]) > len(size) // 3  # best fit misses the bound
    assert packing.worth(crossed[1], 2048) > packing.worth(alone[1], 2048)


@pytest.mark.parametrize("shard", [packing.SHARD, 16])
def test_sequences_are_made_of_the_documents(spark, tokenizer, shard):
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 900)) for _ in range(12)] + [prose(rng, 4000)]
    docs = documents(spark, texts)
    docs = docs.unionAll(docs)  # as the source mix repeats rows: (doc_id, piece) is no key
    tokens = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4") for t in texts]
    seen = []
    for r in packing.packed_sequences(docs, NAME, shard=shard).collect():
        ids, at = np.frombuffer(bytes(r["ids"]), "<u4"), 0
        for p in r["parts"]:
            assert p["offset"] == at
            assert ids[at : at + p["length"]].tolist() == tokens[p["doc_id"]][p["start"] : p["start"] + p["length"]].tolist()
            at += p["length"]
            seen.append((p["item"], p["doc_id"], p["piece"]))
        assert len(ids) == at <= packing.LENGTH
    assert len({item for item, _, _ in seen}) == len(seen)
    want = sorted((i, n) for i, t in enumerate(tokens) for n in range(-(-len(t) // packing.LENGTH)) for _ in range(2))
    assert sorted((i, n) for _, i, n in seen) == want


def test_a_large_vocabulary_keeps_32_bits(spark, monkeypatch):
    docs = documents(spark, ["a b c", "d e"])
    narrow = {r["doc_id"]: (len(r["ids"]), r["length"]) for r in packing.pieces(docs, NAME).collect()}
    assert all(size == 2 * length for size, length in narrow.values())
    wide = packing.pieces(docs, NAME, end=70_000).collect()
    assert all(np.frombuffer(bytes(r["ids"]), "<u4")[-1] == 70_000 for r in wide)
    assert packing._wide(b"\x01\x00\x02\x00", 2) == packing._wide(b"\x01\0\0\0\x02\0\0\0", 2) == b"\x01\0\0\0\x02\0\0\0"


def test_whole_sequences_beside_their_first_pieces(spark):
    texts = [prose(random.Random(6), 500), "a b", None] * 4
    rows = packing.packed_pieces(documents(spark, texts), NAME, digest=[F.crc32("ids").alias("crc")], whole=True).collect()
    assert len({r["item"] for r in rows}) == len(rows)
    whole = {r["sequence_id"]: bytes(r["sequence"]) for r in rows if r["offset"] == 0}
    for r in rows:
        part = whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["crc"] and (r["sequence"] is None) == (r["offset"] > 0)


def test_empty_table(spark):
    assert packing.packed_pieces(spark.createDataFrame([], DOCS), NAME).count() == 0
