"""Best-fit packing of token pieces by swap-based local search.

Pieces are dealt at random into groups that fit one task. A group starts from best fit
decreasing and then exchanges pieces between underfull bins, one for one, two for one, one
for two, or moves them, always from an emptier to a fuller bin, which raises the sum of
squared fills until bins are empty. Bins that stay underfull, the emptiest ones with up to half
of a group's rows, are dealt anew with those of other groups, level by level, until one group is
left; there the search ends when no bin can be emptied any more.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import insort
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from pledgeflow.llm.text_batches import ship
from pledgeflow.session import materialise

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# word parts kept in a worker's memo, the longest that is kept, and text bytes encoded at once (of one text at least)
MEMO, MEMO_BYTES, CHUNK_BYTES = 400_000, 48, 4 << 20
# words whose letters and marks the tokenizer splits apart, all in its normal form once lowered
_PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


class WordTokenizer:
    """Token ids of whole texts, through the distinct words of a batch.

    The tokenizer drops white space and never merges across it, so a text's ids are those of
    its words. Plain letters and marks are split apart by it too, so they are looked up alone.
    """

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        self.model = self.full.model
        shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
        hidden = [b for b in range(256) if b not in shown]
        characters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.characters = [characters[b] for b in range(256)]
        self.memo: dict[str, bytes] = {}

    def _plain(self, part: str) -> bytes:
        """Ids of lowered letters, or of marks."""
        text = part if part.isascii() else "".join([self.characters[b] for b in part.encode()])
        return array("I", [token.id for token in self.model.tokenize(text)]).tobytes()

    def _any(self, word: str) -> bytes:
        return array("I", self.full.encode(word, add_special_tokens=False).ids).tobytes()

    def _ragged(self, parts: pa.Array, kind: str, make) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Indexes into distinct ``parts``, and their packed ids with starts and lengths."""
        coded = parts.dictionary_encode()
        memo, packed = self.memo, []
        for part in coded.dictionary.to_pylist():
            key = kind + part
            ids = memo.get(key)
            if ids is None:
                ids = make(part)
                if len(part) <= MEMO_BYTES:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[key] = ids
            packed.append(ids)
        lengths = np.array([len(ids) for ids in packed], np.int64) // 4
        return coded.indices, np.frombuffer(b"".join(packed), np.uint32), _starts(lengths), lengths

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed ids of distinct words, with starts and lengths."""
        found = pc.extract_regex(words, _PLAIN)
        plain = found.is_valid()
        letters = pc.utf8_lower(found.field(0)).filter(plain)
        parts = (
            (plain, self._ragged(letters, "a", self._plain)),
            (plain, self._ragged(found.field(1).filter(plain), "a", self._plain)),
            (pc.invert(plain), self._ragged(words.filter(pc.invert(plain)), "w", self._any)),
        )
        total, pieces = np.zeros(len(words), np.int64), []
        for held, (indices, ids, starts, lengths) in parts:
            at, index = np.flatnonzero(held.to_numpy(zero_copy_only=False)), indices.to_numpy(zero_copy_only=False)
            pieces.append((at, ids, starts[index], lengths[index], total[at]))
            total[at] += lengths[index]
        starts = _starts(total)
        out = np.empty(int(total.sum()), np.uint32)
        for at, ids, first, lengths, shift in pieces:
            out[_spans(starts[at] + shift, lengths)] = ids[_spans(first, lengths)]
        return out, starts, total

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a string array without nulls."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        ids, starts, lengths = self._words(coded.dictionary)
        words = coded.indices.to_numpy(zero_copy_only=False)
        sizes = lengths[words]
        flat = ids[_spans(starts[words], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield flat[first:last]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indexes from each start on, for each length."""
    return np.repeat(starts - _starts(lengths), lengths) + np.arange(int(lengths.sum()))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(
    df: DataFrame,
    text: str = "text",
    passed: Sequence[str] = ("doc_id",),
    size: int = 2048,
    end_id: int = 0,
    tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """Cut each document's ids, closed by ``end_id``, into pieces of at most ``size`` tokens.

    ``kept`` (struct of passed columns), ``piece``, ``start``, ``length``, ``ids_crc32`` over the
    piece's little-endian 32-bit ids and, if asked for, the ``ids``. A null text is empty: its
    document is the end id alone. ``tokenizer`` is a file that every executor can open.
    """
    base = df.select(F.struct(*[F.col(c) for c in passed]).alias("kept"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([base.schema["kept"]])
    schema.add("piece", T.IntegerType())
    for name in ("start", "length", "ids_crc32"):
        schema.add(name, T.LongType())
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))
    closing = np.array([end_id], np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_bytes(batch):
                rows = []
                for i, ids in enumerate(word_tokenizer(tokenizer).encode(part.column("text"))):
                    ids = np.concatenate([ids, closing])
                    for number, at in enumerate(range(0, len(ids), size)):
                        piece = ids[at : at + size]
                        rows.append((i, number, at, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), piece))
                source, *columns, pieces = zip(*rows, strict=True)
                arrays = [part.column("kept").take(pa.array(source, pa.int32())), *map(pa.array, columns)]
                if with_ids:
                    arrays.append(pa.array([p.view(np.int32) for p in pieces], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [a.cast(t) for a, t in zip(arrays, _arrow_types(arrays, with_ids), strict=True)], names=schema.names
                )

    return ship(base).mapInArrow(cut, schema)


def _arrow_types(arrays: list[pa.Array], with_ids: bool) -> list[pa.DataType]:
    return [arrays[0].type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * with_ids]


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``CHUNK_BYTES`` of text, of one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last


class _Pool:
    """Pieces of open bins by length, with the lengths present as bits of one integer."""

    def __init__(self):
        self.bins: dict[int, set[int]] = {}
        self.present = 0

    def add(self, length: int, number: int) -> None:
        self.bins.setdefault(length, set()).add(number)
        self.present |= 1 << length

    def discard(self, length: int, number: int) -> None:
        held = self.bins[length]
        held.discard(number)
        if not held:
            del self.bins[length]
            self.present ^= 1 << length


def best_fit(lengths: Sequence[int], size: int) -> list[list[int]]:
    """Best fit decreasing: every piece goes to the fullest bin that holds it. Bins of indexes."""
    bins: list[list[int]] = []
    by_gap: dict[int, list[int]] = {}
    gaps = 0
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[item]
        fitting = gaps >> length
        if fitting:
            gap = length + (fitting & -fitting).bit_length() - 1
            number = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
        else:
            gap, number = size, len(bins)
            bins.append([])
        bins[number].append(item)
        gap -= length
        if gap:
            by_gap.setdefault(gap, []).append(number)
            gaps |= 1 << gap
    return bins


def local_search(bins: list[list[int]], lengths: Sequence[int], size: int, donors: int = 12, concentrate: bool = True) -> list[list[int]]:
    """Raise the sum of squared fills by exchanges between underfull bins until none helps.

    Bins are filled from the fullest down. A bin gives up none, one or two of its pieces for a
    longer one, or none or one for two of an emptier bin's pieces, taking the exchange that fills it
    most. Pairs to take are looked for in the ``donors`` emptiest bins. Without ``concentrate`` the
    search ends as soon as the bins are as few as their pieces allow; with it, the gaps that are
    left come together in few bins, which another group's may then fill.
    """
    fill = {i: sum(lengths[x] for x in items) for i, items in enumerate(bins)}
    done = [items for i, items in enumerate(bins) if fill[i] == size]
    held = {i: list(items) for i, items in enumerate(bins) if fill[i] < size}
    surplus = len(held) - -(-sum(fill[i] for i in held) // size)
    pairs: dict[int, int] = {}
    while True:
        gained = False
        pool = _Pool()
        order = sorted(held, key=lambda i: fill[i])
        for i in order:
            for x in held[i]:
                pool.add(lengths[x], i)
        while order:
            if not surplus and not concentrate:
                return done + list(held.values())
            taker = order.pop()
            if taker not in held:
                continue
            for x in {lengths[x] for x in held[taker]}:
                pool.discard(x, taker)
            while fill[taker] < size and (swap := _best_swap(held, lengths, fill, pool, pairs, taker, size, order[:donors])):
                giver, given, taken = swap
                for x in {lengths[x] for x in held[giver]}:
                    pool.discard(x, giver)
                held[taker] = [x for x in held[taker] if x not in given] + list(taken)
                held[giver] = [x for x in held[giver] if x not in taken] + list(given)
                pairs.pop(taker, None)
                pairs.pop(giver, None)
                change = sum(lengths[x] for x in taken) - sum(lengths[x] for x in given)
                fill[taker] += change
                fill[giver] -= change
                gained = True
                order.remove(giver)
                if held[giver]:
                    for x in held[giver]:
                        pool.add(lengths[x], giver)
                    insort(order, giver, key=lambda i: fill[i])
                else:
                    del held[giver]
                    surplus -= 1
                    if not surplus and not concentrate:
                        break
            if fill[taker] == size:
                done.append(held.pop(taker))
        if not gained:
            return done + list(held.values())


def _sums(items: Sequence[int], lengths: Sequence[int]) -> tuple[int, int]:
    """Lengths of single pieces and of pairs, as bits of two integers."""
    singles = pairs = 0
    for x in items:
        pairs |= singles << lengths[x]
        singles |= 1 << lengths[x]
    return singles, pairs


def _pieces(items: Sequence[int], lengths: Sequence[int], total: int, most: int) -> tuple[int, ...]:
    """None, one or two of ``items`` (``most`` at most) of ``total`` length together."""
    if not total:
        return ()
    by_length: dict[int, int] = {}
    for x in items:
        if lengths[x] == total:
            return (x,)
        if most > 1 and total - lengths[x] in by_length:
            return by_length[total - lengths[x]], x
        by_length[lengths[x]] = x
    raise ValueError("no such pieces")


def _best_swap(held, lengths, fill, pool, pairs, taker, size, donors):
    """(giver, pieces given up, pieces taken) that fills ``taker`` most, or None.

    Lengths are bits: a gain is possible where the lengths on offer, shifted down by it, meet one
    that ``taker`` can give up.
    """
    own = held[taker]
    singles, doubles = _sums(own, lengths)
    few = singles | 1
    given_up, offered = few | doubles, 0
    donors = [d for d in donors if d in held]
    for d in donors:
        if d not in pairs:
            pairs[d] = _sums(held[d], lengths)[1]
        offered |= pairs[d]
    gap = size - fill[taker]
    gain, out = _best_gain(given_up, pool.present, gap)
    more, low = _best_gain(few, offered, gap) if gain < gap and offered else (0, 0)
    if more > gain:
        giver = next(d for d in donors if pairs[d] >> (low + more) & 1)
        return giver, _pieces(own, lengths, low, 1), _pair(held[giver], lengths, low + more)
    if gain:
        giver = min(pool.bins[out + gain], key=lambda i: (fill[i], i))
        return giver, _pieces(own, lengths, out, 2), _pieces(held[giver], lengths, out + gain, 1)
    return None


def _best_gain(given_up: int, offered: int, gap: int) -> tuple[int, int]:
    """The largest gain up to ``gap``, and the length given up for it; (0, 0) if there is none."""
    if given_up.bit_count() >= gap:
        for gain in range(gap, 0, -1):
            if fitting := (offered >> gain) & given_up:
                return gain, (fitting & -fitting).bit_length() - 1
        return 0, 0
    best = at = 0
    while given_up and best < gap:
        low = given_up & -given_up
        given_up ^= low
        out = low.bit_length() - 1
        gain = (offered & ((1 << (out + gap + 1)) - 1)).bit_length() - 1 - out
        if gain > best:
            best, at = gain, out
    return best, at


def _pair(items: Sequence[int], lengths: Sequence[int], total: int) -> tuple[int, int]:
    """Two of ``items`` of ``total`` length together."""
    by_length: dict[int, int] = {}
    for x in items:
        if total - lengths[x] in by_length:
            return by_length[total - lengths[x]], x
        by_length[lengths[x]] = x
    raise ValueError("no such pair")


def pack_lengths(lengths: Sequence[int], size: int, concentrate: bool = False) -> list[list[int]]:
    """Bins of indexes into ``lengths``."""
    return local_search(best_fit(lengths, size), lengths, size, concentrate=concentrate)


def pack(pieces: DataFrame, size: int = 2048, length: str = "length", group_rows: int = 60_000) -> DataFrame:
    """Place every row of ``pieces`` in a sequence of at most ``size`` tokens.

    Adds ``sequence_id`` and ``offset`` (gapless from 0) to the columns of ``pieces``; lengths lie
    between 1 and ``size``. Repeated rows are placed once each. Rows are dealt evenly into groups
    of about ``group_rows`` whatever their values; of the bins left underfull, the emptiest ones with up
    to half of a group's rows go on to the next level, so that levels shrink whatever the lengths are.
    An empty table gives no rows.
    """
    rest = materialise(pieces.select(F.struct("*").alias("item"), F.col(length).cast("int").alias("length")))
    schema = T.StructType(rest.schema.fields[:])
    schema.add("sequence_id", T.LongType()).add("offset", T.LongType()).add("open", T.BooleanType())
    left, level, closed = rest.count(), 0, []
    while True:
        groups = max(1, -(-left // group_rows))
        placed = materialise(rest.repartition(groups).mapInArrow(_pack_group(size, level, groups == 1), schema))
        if groups == 1:
            closed.append(placed)
            break
        closed.append(placed.filter("not open"))
        rest = placed.filter("open").select("item", "length")
        left, level = rest.count(), level + 1
    return reduce(DataFrame.unionByName, closed).select("item.*", "sequence_id", "offset")


def _pack_group(size: int, level: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        lengths = table.column("length").to_pylist()
        first = level << 56 | TaskContext.get().partitionId() << 32
        order, sequence, offset, is_open, sent = [], [], [], [], 0
        bins = sorted(pack_lengths(lengths, size, not last), key=lambda items: sum(lengths[x] for x in items))
        for number, items in enumerate(bins):
            at = 0
            for item in items:
                order.append(item)
                sequence.append(first + number)
                offset.append(at)
                at += lengths[item]
            sent += len(items)
            is_open.extend([not last and at < size and 2 * sent <= len(lengths)] * len(items))
        out = table.take(pa.array(order, pa.int64())).combine_chunks()
        for name, values, kind in (
            ("sequence_id", sequence, pa.int64()),
            ("offset", offset, pa.int64()),
            ("open", is_open, pa.bool_()),
        ):
            out = out.append_column(name, pa.array(values, kind))
        yield from out.to_batches(max_chunksize=10_000)

    return run


def pack_documents(df: DataFrame, text: str = "text", passed: Sequence[str] = ("doc_id",), size: int = 2048, **settings) -> DataFrame:
    """Tokenise, cut and pack documents: ``kept``, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(df, text, passed, size, **settings), size)
