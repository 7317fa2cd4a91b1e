"""Packing token sequences into as few rows of fixed length as possible.

Documents become pieces of at most one row; a full piece is a row of its own. The others are packed by
a grouping genetic algorithm: a child takes whole well-filled bins from one parent, the other parent's
bins that hold the same pieces go, and what they still held is put back by best fit. The pieces are
dealt out over shards; several islands evolve on each shard and hand each other their best solutions
between rounds. What is left in half-empty bins of all shards is packed once more, over fewer shards.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from priceloom.session import settle

LENGTH = 2048
#: Pieces in a shard, islands on it, solutions on an island, children in a round.
SHARD, ISLANDS, POPULATION, CHILDREN = 16_384, 2, 3, 5
SEED = 11
#: A sequence's number: level, shard and bin.
_LEVEL, _BIN = 1 << 56, 1 << 24
#: Bins emptier than this are packed again with those of other shards.
WELL_FILLED = 0.97


# --- tokens ------------------------------------------------------------------------------------------


def _little(ids: list[int]) -> bytes:
    held = array("I", ids)
    if sys.byteorder == "big":
        held.byteswap()
    return held.tobytes()


class Encoder:
    """Token ids of texts for a tokenizer that never joins anything across white space.

    Ids of white-space separated chunks are remembered, and looked up once for all texts of a call. Where all ASCII
    marks stand between spaces, Latin letters and digits, the common ones are set apart first: such a mark is a
    token of its own. Otherwise a chunk that is a plain Latin word between marks is put together from its parts.
    New words are encoded in one call for many texts.
    Texts with characters whose lower case or class depends on what surrounds them, or with markers of
    special tokens, are encoded whole.
    """

    _MARKS = ".,;:!?()\"|-/"
    # A mark beside what may be one token with it: anything but a space, a Latin letter or a digit.
    _RUN = r"[!-/:-@\[-`{-~][^\sa-z0-9ß-öø-ɏ]|[^\sa-z0-9ß-öø-ɏ][!-/:-@\[-`{-~]"
    _SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
    _ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "İ", "Σ", "<|")
    _PARTS = re.compile(r"([!-&(-/:-@\[-`{-~]*)([a-zß-öø-ɏ]+)([!-/:-@\[-`{-~]*)")
    MOST = 700_000  # remembered chunks, about 120 MB

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self._bare = Tokenizer(self._whole.model)
        self._bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self._whole.get_vocab()
        self.largest = max(vocabulary.values())
        self._ends = np.zeros(self.largest + 1, bool)
        self._ends[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[str, bytes] = {}
        # How byte-level models spell bytes: printable Latin-1 as it is, the others from U+0100 on. Spaces stay, between words.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in plain]
        self._spelt = np.arange(256, dtype="<u2")
        self._spelt[others] = 256 + np.arange(len(others))
        self._spelt[ord(" ")] = ord(" ")

    def _encode(self, text: str) -> bytes:
        return _little(self._whole.encode(text, add_special_tokens=False).ids)

    def _learn(self, chunks: list[str]) -> None:
        known = self._known
        if len(known) + len(chunks) > self.MOST:
            known.clear()
        words, spelt, joined = [], set(), []
        for chunk in chunks:
            if chunk.isascii() and chunk.isalpha():
                words.append(chunk)
            elif match := self._PARTS.fullmatch(chunk):
                parts = match.groups()
                spelt.add(parts[1])
                if len(parts[1]) < len(chunk):
                    joined.append((chunk, parts))
                    for mark in (parts[0], parts[2]):
                        if mark and mark not in known:
                            known[mark] = self._encode(mark)
            else:
                known[chunk] = self._encode(chunk)
        if spelt:
            spelt = [w for w in spelt.difference(words) if w not in known]
            words += spelt
        if words:
            text = " ".join(words)
            if spelt:
                text = self._spelt[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(self._bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * (np.nonzero(self._ends[ids])[0] + 1)).tolist()  # a word's last token, and no other, ends in </w>
            held = ids.tobytes()
            known.update(zip(words, (held[a:b] for a, b in zip([0, *cuts], cuts, strict=False)), strict=True))
        for chunk, (before, word, after) in joined:
            known[chunk] = (known[before] if before else b"") + known[word] + (known[after] if after else b"")

    def _apart(self, text: str) -> str:
        for mark in self._MARKS:
            if mark in text:
                text = text.replace(mark, f" {mark} ")
        return text

    def _spaced(self, text: str) -> str:
        """``text`` without white space that is not ASCII."""
        if not text.isascii() and any(space in text for space in self._SPACES):
            return " ".join(text.split())
        return text

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        odd = [any(sign in text for sign in self._ODD) for text in texts]
        plain = ["" if o else self._spaced(text.lower()) for text, o in zip(texts, odd, strict=True)]
        runs = pc.match_substring_regex(pa.array(plain, pa.large_string()), self._RUN).to_pylist()
        plain = [text if run else self._apart(text) for text, run in zip(plain, runs, strict=True)]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        # A chunk that these texts repeat is looked up once.
        coded = split.values.dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._known.get, chunks))
        if None in found:
            self._learn([c for c, ids in zip(chunks, found, strict=True) if ids is None])
            known = self._known
            found = [known[c] if ids is None else ids for c, ids in zip(chunks, found, strict=True)]
        held = pa.array(found, pa.large_binary()).take(coded.indices)
        _, starts, data = held.buffers()
        cuts = np.frombuffer(starts, np.int64, len(held) + 1)[split.offsets.to_numpy()].tolist()
        joined = memoryview(data or b"")
        return [self._encode(t) if o else bytes(joined[a:b]) for t, o, a, b in zip(texts, odd, cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids) of each row: its ids, then ``end``; only longer ones are cut.

    ``ids`` is little-endian unsigned binary, of 16 bits where the vocabulary allows it, else of 32: its size
    over ``length`` tells. ``tokenizer`` is the file's path or, for the public
    ones, its name: each executor looks for its own copy. Null texts count as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers are reused: what an encoder has seen serves later tasks.
        if tokenizer not in _ENCODERS:
            import os

            path = tokenizer
            if not os.path.isabs(path):
                import public_tokenizers

                path = public_tokenizers.path(tokenizer)
            _ENCODERS[tokenizer] = Encoder(path)
        encoder, last = _ENCODERS[tokenizer], np.array([end], "<u4").tobytes()
        narrow = max(encoder.largest, end) < 1 << 16
        width = 2 if narrow else 4
        for batch in batches:
            start = 0
            while start < batch.num_rows:  # some texts at a time, long ones alone
                texts, held = [], 0
                while start + len(texts) < batch.num_rows and held < 1 << 20:
                    texts.append(batch.column(1)[start + len(texts)].as_py() or "")
                    held += len(texts[-1])
                out = []
                for doc, ids in zip(batch.column(0).slice(start, len(texts)).to_pylist(), encoder.ids(texts), strict=True):
                    ids += last
                    if narrow:
                        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
                    for n, at in enumerate(range(0, len(ids), width * length)):
                        part = ids[at : at + width * length]
                        out.append((doc, n, at // width, len(part) // width, part))
                yield _rows(out)
                start += len(texts)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"]
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


# --- the grouping genetic algorithm ------------------------------------------------------------------


def best_fit(order: list[int], size: list[int], bins: list[list[int]], room: list[int], capacity: int = LENGTH) -> None:
    """Put each piece of ``order`` into the fullest bin that has room for it, or into a new one of ``capacity``."""
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for b, r in enumerate(room):
        if r > 0:
            by_room.setdefault(r, []).append(b)
            rooms |= 1 << r
    for item in order:
        s = size[item]
        fits = rooms >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            holders = by_room[r]
            b = holders.pop()
            if not holders:
                rooms ^= 1 << r
        else:
            b, r = len(bins), capacity
            bins.append([])
            room.append(r)
        bins[b].append(item)
        r -= s
        room[b] = r
        if r:
            by_room.setdefault(r, []).append(b)
            rooms |= 1 << r


def worth(room: list[int], capacity: int) -> tuple[int, int]:
    """Fewer bins first, then the emptier its emptiest ones: full bins count more than two half-full ones."""
    return -len(room), sum((capacity - r) ** 2 for r in room)


def cross(mother: tuple, father: tuple, size: list[int], capacity: int, chance: Random) -> tuple:
    """The father's bins, but for well-filled ones of the mother that are put in whole."""
    bins_m, room_m = mother
    bins_f, room_f = father
    good = [b for b, r in enumerate(room_m) if r <= capacity * (1 - WELL_FILLED)] or list(range(len(bins_m)))
    chosen = chance.sample(good, max(1, len(good) * chance.randint(20, 60) // 100))
    held = {item for b in chosen for item in bins_m[b]}
    bins = [bins_m[b] for b in chosen]
    room = [room_m[b] for b in chosen]
    displaced: list[int] = []
    # Beside the bins with duplicates the emptiest ones are opened too.
    emptiest = set(sorted(range(len(bins_f)), key=lambda b: -room_f[b])[: 1 + len(bins_f) // 50])
    for b, items in enumerate(bins_f):
        if b in emptiest or not held.isdisjoint(items):
            displaced += [i for i in items if i not in held]
        else:
            bins.append(items)
            room.append(room_f[b])
    bins = [list(b) if r else b for b, r in zip(bins, room, strict=True)]
    displaced.sort(key=lambda i: -size[i])
    best_fit(displaced, size, bins, room, capacity)
    return bins, room


def evolve(size: list[int], seeds: list[tuple], capacity: int, chance: Random, children: int = CHILDREN) -> list[tuple]:
    """The best solutions, best first, from ``seeds`` and fresh ones."""
    people = list(seeds)
    while len(people) < POPULATION:
        # Best fit in falling order, then in orders that are falling up to noise.
        noise = 0.0 if not people else 0.15
        order = sorted(range(len(size)), key=lambda i: -size[i] * (1 + noise * chance.random()))
        bins: list[list[int]] = []
        room: list[int] = []
        best_fit(order, size, bins, room, capacity)
        people.append((bins, room))
    bound = -(-sum(size) // capacity)
    for _ in range(children):
        people.sort(key=lambda p: worth(p[1], capacity), reverse=True)
        if len(people[0][0]) <= bound:
            break  # nothing packs into fewer
        mother, father = chance.sample(people, 2)
        people[-1] = cross(mother, father, size, capacity, chance)
    people.sort(key=lambda p: worth(p[1], capacity), reverse=True)
    return people


_STATE = "shard long, island int, person int, item long, length int, bin int, place int"


def _round(keys: list[str], number: int, keep: int, capacity: int, seed: int):
    """One round of a group: solutions in (person -1: bare pieces), its ``keep`` best out."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        at = {name: rows.column(name).to_numpy() for name in ("island", "person", "item", "length", "bin")}
        shard = key[0].as_py()
        island = key[1].as_py() if len(keys) > 1 else 0
        items, first = np.unique(at["item"], return_index=True)
        size = at["length"][first].tolist()
        index = np.searchsorted(items, at["item"])
        seeds = []
        who = at["person"].astype(np.int64) * 1000 + at["island"]
        for person in np.unique(who[at["person"] >= 0]):
            mine = np.nonzero(who == person)[0]
            mine = mine[np.argsort(at["bin"][mine], kind="stable")]
            cuts = np.nonzero(np.diff(at["bin"][mine]))[0] + 1
            bins = [b.tolist() for b in np.split(index[mine], cuts)]
            seeds.append((bins, [capacity - sum(size[i] for i in b) for b in bins]))
        best = evolve(size, seeds, capacity, Random(f"{seed} {shard} {island} {number}"))[:keep]
        order = [np.array([i for b in bins for i in b], np.int64) for bins, _ in best]
        bin_of = [np.repeat(np.arange(len(bins)), [len(b) for b in bins]) for bins, _ in best]
        n = len(items)
        lengths = np.array(size, np.int64)
        place = []
        for o, b in zip(order, bin_of, strict=True):
            before = np.cumsum(lengths[o]) - lengths[o]
            starts = np.nonzero(np.concatenate([[True], b[1:] != b[:-1]]))[0]
            place.append(before - np.repeat(before[starts], np.diff(np.concatenate([starts, [n]]))))
        flat = np.concatenate(order)
        return pa.table({
            "shard": pa.array(np.full(len(flat), shard), pa.int64()),
            "island": pa.array(np.full(len(flat), island), pa.int32()),
            "person": pa.array(np.repeat(np.arange(len(best)), n), pa.int32()),
            "item": pa.array(items[flat]),
            "length": pa.array(lengths[flat], pa.int32()),
            "bin": pa.array(np.concatenate(bin_of), pa.int32()),
            "place": pa.array(np.concatenate(place), pa.int32()),
        })

    return run


def _shard(shards: int, seed: int) -> Column:
    """The shard of an item: a hash, so whoever knows the item knows its shard."""
    return F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(shards)).alias("shard")


def _pack_shards(items: DataFrame, shards: int, capacity: int, seed: int) -> DataFrame:
    """(shard, item, length, bin, place): one solution for each of ``shards`` shards of (item, length)."""
    dealt = items.select(
        _shard(shards, seed),
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        F.lit(-1).alias("person"), "item", F.col("length").cast("int").alias("length"),
        F.lit(0).alias("bin"), F.lit(0).alias("place"),
    )
    islands = dealt.groupBy("shard", "island").applyInArrow(_round(["shard", "island"], 0, 1, capacity, seed), _STATE)
    islands = settle(islands, "islands")
    # Migration: the elite of each island also lives on the next one.
    moved = islands.withColumns({"island": (F.col("island") + 1) % ISLANDS, "person": F.col("person") + 1})
    both = islands.unionAll(moved)
    islands = settle(
        both.groupBy("shard", "island").applyInArrow(_round(["shard", "island"], 1, 1, capacity, seed), _STATE), "islands"
    )
    return settle(islands.groupBy("shard").applyInArrow(_round(["shard"], 2, 1, capacity, seed), _STATE), "packed")


def pack(items: DataFrame, capacity: int = LENGTH, seed: int = SEED, shard: int = SHARD) -> DataFrame:
    """(item, sequence_id, offset) for unique ``item`` (long) and ``length`` (1..capacity).

    Sequences are filled without gaps from offset 0. Equal lengths are interchangeable; an empty table
    gives none. Each level packs what the one before left in half-empty bins, over as many fewer shards.
    """
    full = items.where(F.col("length") >= capacity)
    done = full.select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = items.where(F.col("length") < capacity).select("item", "length")
    level, before = 0, None
    while True:
        count = left.count()
        shards = max(1, -(-count // shard))
        if not count:
            return done
        packed = _pack_shards(left, shards, capacity, seed + level)
        number = F.col("shard") * _BIN + F.col("bin") + F.lit(level * _LEVEL)
        placed = packed.select("item", number.alias("sequence_id"), F.col("place").cast("long").alias("offset"))
        if shards == 1 or before is not None and count > before // 2:
            return done.unionAll(placed)
        fill = packed.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
        loose = fill.where(F.col("fill") < capacity * WELL_FILLED).select("shard", "bin")
        kept = packed.join(loose, ["shard", "bin"], "left_anti")
        done = done.unionAll(kept.select("item", number.alias("sequence_id"), F.col("place").cast("long").alias("offset")))
        left = settle(packed.join(loose, ["shard", "bin"], "left_semi").select("item", "length"), "loose")
        level, before = level + 1, count


_PARTS = "array<struct<offset: long, item: long, doc_id: long, piece: int, start: long, length: long>>"
_ROWS = f"sequence_id long, ids binary, parts {_PARTS}"


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(sequence_id, ids, parts): the packed rows of ``docs``, each with the pieces it holds, in order.

    ``ids`` is little-endian unsigned 32-bit binary. ``parts`` has (offset, item, doc_id, piece, start,
    length), offset and length in tokens; ``item`` tells pieces of repeated rows apart. Repeated rows are
    packed each; null texts hold the end token alone. The pieces are written once, with their ids; a full one
    is a sequence as it is. Of the others a shard's ids meet its placements in one exchange; only pieces that
    were left over there and went to another shard move again.
    """
    held = pieces(docs, tokenizer, capacity).withColumn("item", F.monotonically_increasing_id())
    held = settle(held.select("item", "doc_id", "piece", "start", "length", "ids"), "pieces")
    full, left = held.where(F.col("length") >= capacity), held.where(F.col("length") < capacity)
    # Renamed: placements and pieces stem from one table and meet again.
    placed = pack(left.select("item", "length"), capacity, SEED, shard).toDF("_item", "sequence_id", "offset")
    shards = max(1, -(-left.count() // shard))
    here = placed.where(F.col("sequence_id") < _LEVEL).withColumn("shard", F.floor(F.col("sequence_id") / _BIN))
    dealt = left.withColumn("shard", _shard(shards, SEED))
    near = here.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(_shard_rows, _ROWS)
    told = [c for c in held.columns if c != "ids"]
    alone = F.array(F.struct(F.lit(0).cast("long").alias("offset"), *told)).alias("parts")
    later = placed.where(F.col("sequence_id") >= _LEVEL).withColumnRenamed("_item", "item")
    others = sequences(left, later).unionByName(
        full.select((-1 - F.col("item")).alias("sequence_id"), "ids", alone)
    )
    return near.unionByName(others.select("sequence_id", "ids", F.col("parts").cast(_PARTS)).mapInArrow(_widened, _ROWS))


def _wide(ids: bytes | memoryview, tokens: int) -> bytes:
    """32-bit ids of 16-bit or 32-bit ones."""
    return bytes(ids) if len(ids) == 4 * tokens else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            some = batch.slice(start, 512)
            parts = some.column(2)
            lengths = parts.flatten().field("length").to_numpy()
            ends = np.cumsum(parts.value_lengths().to_numpy())
            tokens = np.add.reduceat(lengths, np.concatenate([[0], ends[:-1]]))
            ids = [_wide(i.as_buffer(), n) for i, n in zip(some.column(1), tokens.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(ids, pa.binary()), parts], ["sequence_id", "ids", "parts"])


def _shard_rows(placed: pa.Table, held: pa.Table) -> pa.Table:
    """The rows of one shard, from where its pieces lie and the pieces."""
    placed = placed.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
    items = held.column("item").to_numpy()
    order = np.argsort(items)
    at = order[np.searchsorted(items, placed.column("_item").to_numpy(), sorter=order)]
    sequence = placed.column("sequence_id").to_numpy()
    starts = np.nonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))[0] if len(sequence) else np.zeros(0, int)
    told = held.select(["item", "doc_id", "piece", "start", "length"]).take(at).combine_chunks()
    names = ["offset", *told.column_names]
    columns = [placed.column("offset").combine_chunks(), *(c.combine_chunks() for c in told.columns)]
    ids, tokens = held.column("ids").take(at).combine_chunks(), told.column("length").to_numpy()
    out = []
    for first in range(0, len(starts), 256):  # rows that leave together
        some = starts[first : first + 256]
        stop = starts[first + 256] if first + 256 < len(starts) else len(sequence)
        bounds = [*some.tolist(), int(stop)]
        rows = [
            b"".join(_wide(ids[n].as_buffer(), tokens[n]) for n in range(a, b)) for a, b in zip(bounds, bounds[1:], strict=False)
        ]
        parts = pa.StructArray.from_arrays([c.slice(bounds[0], bounds[-1] - bounds[0]) for c in columns], names)
        offsets = pa.array(np.array(bounds) - bounds[0], pa.int32())
        arrays = [pa.array(sequence[some]), pa.array(rows, pa.binary()), pa.ListArray.from_arrays(offsets, parts)]
        out.append(pa.RecordBatch.from_arrays(arrays, ["sequence_id", "ids", "parts"]))
    if out:
        return pa.Table.from_batches(out)
    empty = [pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.list_(pa.struct([(n, c.type) for n, c in zip(names, columns, strict=True)])))]
    return pa.Table.from_arrays(empty, ["sequence_id", "ids", "parts"])


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = LENGTH, digest=(), whole: bool = False) -> DataFrame:
    """(item, doc_id, piece, start, length, *digest, sequence_id, offset): the pieces in `packed_sequences`.

    ``digest`` are columns computed from ``ids``, a piece's ids as its sequence holds them. With ``whole``
    the column ``sequence`` has the ids of the packed row, at its first piece (offset 0) only.
    """
    packed = packed_sequences(docs, tokenizer, capacity)
    found = packed.select("sequence_id", F.col("ids").alias("sequence"), F.explode("parts").alias("part"))
    found = found.select("sequence_id", "sequence", "part.*")
    cut = F.substring("sequence", (F.col("offset") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    columns = ["item", "doc_id", "piece", "start", "length", *digest, "sequence_id", "offset"]
    if whole:
        columns.append(F.when(F.col("offset") == 0, F.col("sequence")).alias("sequence"))
    return found.withColumn("ids", cut).select(*columns)


def sequences(held: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, parts): the packed rows, from (item, ids) that were written and (item, sequence_id, offset).

    ``parts`` has offset, item and the other columns of ``held`` of each piece, in order.
    """
    told = [c for c in held.columns if c != "ids"]
    parts = placed.select("item", "sequence_id", "offset").join(held, "item").groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", *told, "ids"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda out, part: F.concat(out, part["ids"]))
    return parts.select(
        "sequence_id", joined.alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("parts")
    )
