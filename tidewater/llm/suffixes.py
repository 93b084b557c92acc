"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

1. Anchors. Every string of ``length`` bytes has an anchor, the 32 bytes in it
   with the smallest hash; equal strings have equal anchors. Starts in a row
   with one anchor are one context, which reaches from the first start to the
   last string's end. Contexts meet by anchor; an anchor that occurs once has
   no repeats, and of equal contexts all but the first are repeats throughout.
2. Transforms. Different contexts of one anchor are compared byte by byte:
   shards of them are sorted into Burrows-Wheeler transforms, and the shards
   are merged by refining their interleaving, one letter a round. Suffixes that
   no round told apart share ``length`` bytes; all but the earliest repeat.
   An anchor with more than ``MERGE_BYTES`` of contexts is hot: its contexts are
   merged in parts of that size, and the strings that are the earliest of their
   part meet again, each by a hash of its bytes, in further merges.
3. Cutting. The repeats of each document are joined and cut out.

A letter is 25 bytes, read at every byte offset: the suffix at p is preceded by
the letter at p - 25, and four rounds compare 100 bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, staged

LENGTH = 100
ANCHOR = 32
LETTERS = 4
#: Bytes worked on at a time when anchors are chosen.
_CHUNK = 1 << 17
#: Bytes of contexts whose transforms are merged at once (whole anchors, or parts of
#: this size of an anchor that has more), and of one shard.
MERGE_BYTES, SHARD_BYTES = 1 << 20, 1 << 17

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)
_PLACE = np.uint64((1 << 20) - 1)


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes at every offset, as integers (blanks after the end)."""
    padded = data + bytes(8)
    return np.array(np.ndarray((len(data),), "<u8", padded, 0, (1,)))


def _gram_hashes(data: bytes, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes at each offset where they fit."""
    eights, n = _eights(data), len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, at in enumerate([*range(0, width - 8, 8), width - 8]):
        part = eights[at:at + n] * _MIX[k % 5]
        out += part ^ (part >> np.uint64(31 + k))
    out ^= out >> np.uint64(32)
    out *= _MIX[1]
    return out ^ (out >> np.uint64(29))


def contexts(data: bytes, ends: np.ndarray, length: int = LENGTH):
    """Contexts of the documents that are joined in ``data`` and end at
    ``ends``: arrays of anchor hash, first and last start (places in data)."""
    window = length - ANCHOR + 1
    hashes = _gram_hashes(data, ANCHOR)
    count = len(hashes) - window + 1
    if count <= 0:
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty, empty
    # low bits give way to the place, so that the leftmost of equals is least
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= window:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[:count], least[window - reach:window - reach + count])
    anchors = (least & _PLACE).astype(np.int64)
    lengths = np.diff(np.concatenate(([0], ends)))
    fits = np.arange(count) <= (np.repeat(ends, lengths)[:count] - length)
    new = np.empty(count, bool)
    new[0] = True
    np.not_equal(anchors[1:], anchors[:-1], out=new[1:])
    new[1:] |= fits[1:] != fits[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [count])) - 1
    kept = fits[first]
    first, last = first[kept], last[kept]
    return hashes[anchors[first]], first, last


def _chunks(texts: list[bytes], length: int):
    """(joined bytes, ends, numbers of the documents, offset of the first in
    its document) of about a chunk; long documents come in overlapping parts."""
    parts: list[bytes] = []
    numbers: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        if len(text) > _CHUNK:
            for start in range(0, len(text) - length + 1, _CHUNK):
                part = text[start:start + _CHUNK + length - 1]
                yield part, np.array([len(part)]), [number], start
            continue
        parts.append(text)
        numbers.append(number)
        size += len(text)
        if size >= _CHUNK:
            yield b"".join(parts), np.cumsum([len(p) for p in parts]), numbers, 0
            parts, numbers, size = [], [], 0
    if parts:
        yield b"".join(parts), np.cumsum([len(p) for p in parts]), numbers, 0


def _ranks(ids: list, versions: list) -> np.ndarray:
    """Places of documents in order of id (null first), then version."""
    keys = [(i is not None, i, v) if i is not None else (False, 0, v) for i, v in zip(ids, versions, strict=True)]
    ranks = np.empty(len(keys), np.int64)
    ranks[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
    return ranks


def _starts(sorted_columns: list[np.ndarray]) -> np.ndarray:
    """Where a run of rows equal in all columns begins."""
    new = np.ones(len(sorted_columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return new


def _find_contexts(length: int):
    """Rows (anchor, context, doc_id, version, place) of all contexts.  place
    is first start << 8 | starts after it << 1 | whether it is known to be a
    repeat.  Repeats within a batch are found here and dealt out at random."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            data = [(t or "").encode() for t in batch.column("text").to_pylist()]
            order = _ranks(ids.to_pylist(), versions.to_pylist())
            found = []
            digest = xxhash.xxh64_intdigest
            for joined, ends, numbers, offset in _chunks(data, length):
                anchor, first, last = contexts(joined, ends, length)
                view = memoryview(joined)
                context = np.fromiter((digest(view[a:b], 7) for a, b in zip(
                    first.tolist(), (last + length).tolist(), strict=True)), np.uint64, len(first))
                within = np.searchsorted(ends, first, side="right")
                before = first - np.concatenate(([0], ends))[within] + offset
                found.append((anchor, context, np.array(numbers)[within], before, last - first))
            if not found:
                continue
            anchor, context, row, start, more = (np.concatenate(x) for x in zip(*found, strict=True))
            by = np.lexsort((start, order[row], context, anchor))
            repeat = np.zeros(len(by), bool)
            repeat[by] = ~_starts([anchor[by], context[by]])
            anchor = np.where(repeat, (context + start.astype(np.uint64)) * _MIX[2] + row.astype(np.uint64), anchor)
            place = start << 8 | more << 1 | repeat
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), ids.take(rows),
                 versions.take(rows), pa.array(place)], names=["anchor", "context", "doc_id", "version", "place"])

    return run


def _compare_contexts(length: int, part_bytes: int):
    """Of rows in order of anchor, context and document: those that repeat an
    equal context (repeat), and the first of each context of an anchor that
    has several (for the transforms).  The rest have no equal anywhere.

    part is 0 where an anchor's contexts have ``part_bytes`` at most; those of
    a hot anchor are dealt to parts 1, 2, ... of about that size."""

    def run(batches):
        import pyarrow as pa

        held: list = []  # first rows of the contexts of the anchor that the last batch ended in, while it is not hot
        told = 0  # bytes of that anchor's contexts, where it is hot and its rows are told
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, context, place = (batch.column(c).to_numpy() for c in ("anchor", "context", "place"))
            new_context = _starts([anchor, context])
            if last is not None:
                new_context[0] = (anchor[0], context[0]) != last[:2]
            repeat = (place & 1).astype(bool) | ~new_context
            if repeat.any():
                yield _told(batch.filter(pa.array(repeat)), True)
            kept = batch.filter(pa.array(~repeat))
            before, last = last, (anchor[-1], context[-1], anchor[~repeat][-1] if kept.num_rows else last and last[2])
            if not kept.num_rows:
                continue
            rows = pa.Table.from_batches([*held, kept]).combine_chunks().to_batches()[0]
            anchor, place = (rows.column(c).to_numpy() for c in ("anchor", "place"))
            new_anchor = _starts([anchor])
            group = np.cumsum(new_anchor) - 1
            size = (place >> 1 & 127) + length
            ends = np.cumsum(size)
            through = ends - size - (ends - size)[new_anchor][group]  # bytes of the anchor before the row
            if told and anchor[0] == before[2]:
                through[group == 0] += told
            else:
                told = 0
            closes = np.append(np.flatnonzero(new_anchor)[1:], len(anchor)) - 1
            totals = (through + size)[closes]
            hot = totals > part_bytes
            several = (np.bincount(group) > 1) | hot
            open_ = not hot[-1]  # the last anchor may go on
            told = 0 if open_ else int(totals[-1])
            several[-1] &= not open_
            if several.any():
                wanted = several[group]
                part = np.where(hot[group], 1 + through // part_bytes, 0)
                yield _told(rows.filter(pa.array(wanted)), False, part[wanted])
            held = [rows.slice(int(np.flatnonzero(new_anchor)[-1]))] if open_ else []
        if held and held[0].num_rows > 1:
            yield _told(held[0], False)

    return run


def _told(batch, repeat: bool, part: np.ndarray | None = None):
    import pyarrow as pa

    part = np.zeros(batch.num_rows, np.int64) if part is None else part
    return pa.RecordBatch.from_arrays(
        [batch.column("anchor"), pa.array(part), *(batch.column(c) for c in ("doc_id", "version", "place")),
         pa.array(np.full(batch.num_rows, repeat))], names=["anchor", "part", "doc_id", "version", "place", "repeat"])


def _cut_contexts(length: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, anchors, parts, starts, pieces = [], [], [], [], []
                for row, (text, wanted) in enumerate(zip(part.column("text").to_pylist(),
                                                         part.column("wanted").to_pylist(), strict=True)):
                    data = text.encode() if wanted else b""
                    for x in wanted or ():
                        start, more = x["place"] >> 8, x["place"] >> 1 & 127
                        rows.append(row)
                        anchors.append(x["anchor"])
                        parts.append(x["part"])
                        starts.append(start)
                        pieces.append(data[start:start + more + length])
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors, pa.int64()), pa.array(parts, pa.int64()), part.column("doc_id").take(take),
                     part.column("version").take(take), pa.array(starts, pa.int64()), pa.array(pieces, pa.binary())],
                    names=["anchor", "part", "doc_id", "version", "start", "bytes"])

    return run


def stable_order(values: np.ndarray) -> np.ndarray:
    """A stable sort of small non-negative integers, by halves."""
    low = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    if values.max(initial=0) < 1 << 16:
        return low
    return low[np.argsort((values >> 16).astype(np.uint16)[low], kind="stable")]


class Shard:
    """The Burrows-Wheeler transform of some strings, over letters of
    ``width`` bytes at every offset, sorted by ``letters`` letters.

    Each string has a suffix at each place where a whole letter fits, and
    ``width`` empty ones; the letter 0 stands for a string's end.  ``suffixes``
    holds the suffixes in order (numbers over all the shard's places),
    ``before`` the letter before each."""

    def __init__(self, codes: list[np.ndarray], width: int, letters: int):
        sizes = np.array([len(c) + width for c in codes])
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        own = np.zeros(offsets[-1], np.int64)
        for code, at in zip(codes, offsets.tolist(), strict=False):
            own[at:at + len(code)] = code
        # the letter k letters on, 0 beyond the string's end
        ends = np.repeat(offsets[1:], sizes)
        places = np.arange(offsets[-1])
        order = places
        for k in reversed(range(letters)):
            at = places + k * width
            column = np.where(at < ends, own[np.minimum(at, offsets[-1] - 1)], 0)
            order = order[stable_order(column[order])]
        self.suffixes = order
        begins = np.repeat(offsets[:-1], sizes)
        previous = order - width
        self.before = np.where(previous >= begins[order], own[previous], 0)
        self.size = int(offsets[-1])


def merge(shards: list[Shard], letters: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of the shards in order (shard offsets added) and, for each,
    the number of its block of suffixes with ``letters`` letters in common.

    ``source`` says which shard each place of the merged order is taken from.
    A round walks the order, takes the letter before each suffix from its
    shard's transform and deals the sources out by letter, which orders them by
    one letter more; where neighbours differ in letter or came from different
    blocks, a block ends.  No suffix is compared with another."""
    source = np.repeat(np.arange(len(shards)), [s.size for s in shards])
    before = np.concatenate([s.before for s in shards])
    block = np.zeros(len(source), np.int64)
    for _ in range(letters):
        letter = np.empty(len(source), np.int64)
        letter[stable_order(source)] = before
        order = stable_order(letter)
        source, letter, block = source[order], letter[order], block[order]
        block = np.cumsum(_starts([letter, block])) - 1
    offsets = np.cumsum([0, *(s.size for s in shards[:-1])])
    suffixes = np.empty(len(source), np.int64)
    suffixes[stable_order(source)] = np.concatenate(
        [s.suffixes + at for s, at in zip(shards, offsets.tolist(), strict=True)])
    return suffixes, block


def repeated_starts(strings: list[bytes], earlier: np.ndarray, length: int = LENGTH,
                    letters: int = LETTERS, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each string, the offsets whose ``length`` bytes also start at an
    offset of a string with a smaller (earlier + offset, by string).

    ``earlier``: for each string an array of its starts' ranks, all different."""
    width = length // letters
    joined = b"".join(strings)
    hashes = _gram_hashes(joined, width)
    sizes = np.array([len(s) for s in strings])
    at = np.concatenate(([0], np.cumsum(sizes)))
    # letters are numbered over all shards, from 1
    place = np.concatenate([np.arange(a, a + n - width + 1) for a, n in zip(at.tolist(), sizes.tolist(), strict=False)])
    code = np.unique(hashes[place], return_inverse=True)[1] + 1
    cuts = np.concatenate(([0], np.cumsum(sizes - width + 1)))
    shards, group, held = [], [], 0
    for k, n in enumerate(sizes.tolist()):
        group.append(code[cuts[k]:cuts[k + 1]])
        held += n
        if held >= shard_bytes or k == len(strings) - 1:
            shards.append(Shard(group, width, letters))
            group, held = [], 0
    suffixes, block = merge(shards, letters)
    # suffixes of which a whole string of the length is there: their string and offset
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    owner = np.searchsorted(bounds, suffixes, side="right") - 1
    offset = suffixes - bounds[owner]
    whole = offset <= (sizes - length)[owner]
    owner, offset, block = owner[whole], offset[whole], block[whole]
    start = at[owner] + offset
    rank = np.concatenate([np.pad(e, (0, n - len(e))) for e, n in zip(earlier, sizes.tolist(), strict=True)])[start]
    order = np.lexsort((rank, block))
    owner, offset, block, start = owner[order], offset[order], block[order], start[order]
    first = _starts([block])
    leader = start[np.flatnonzero(first)][np.cumsum(first) - 1]
    raw = np.frombuffer(joined, np.uint8)
    for k in np.array_split(np.flatnonzero(~first), 1 + len(first) // 65536):  # letters are hashed: compare the bytes
        span = np.arange(length)
        if (raw[start[k][:, None] + span] != raw[leader[k][:, None] + span]).any():
            raise RuntimeError("two letters have one hash")
    found = np.lexsort((offset[~first], owner[~first]))
    owner, offset = owner[~first][found], offset[~first][found]
    return np.split(offset, np.searchsorted(owner, np.arange(1, len(strings))))


def _repeats_of(rows: list, length: int, letters: int) -> list[np.ndarray]:
    """:func:`repeated_starts` of rows that end in doc_id, version, start, bytes."""
    ids, versions, starts, pieces = list(zip(*rows, strict=True))[-4:]
    by = sorted(range(len(rows)), key=lambda k: (ids[k] is not None, ids[k] or 0, versions[k], starts[k]))
    ranks = np.empty(len(rows), np.int64)
    ranks[by] = np.arange(len(rows))
    earlier = [r * 256 + np.arange(len(p) - length + 1) for r, p in zip(ranks.tolist(), pieces, strict=True)]
    return repeated_starts(list(pieces), earlier, length, letters)


_MERGED = ["doc_id", "version", "first", "last", "bytes"]


def _merged(rows: list, id_type):
    """Batches of rows (doc_id, version, first, last, bytes)."""
    import pyarrow as pa

    for at in range(0, len(rows), 1 << 16):
        columns = zip(*rows[at:at + (1 << 16)], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(
                columns, (id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=_MERGED)


def _merge_contexts(length: int, letters: int, merge_bytes: int):
    """Intervals (doc_id, version, first, last) of starts that repeat an
    earlier string, for contexts in order of anchor and part.  Of a hot
    anchor's parts, also the strings that do not (first, bytes, no last)."""

    def told(rows):
        # equal strings have one anchor, so anchors merged together do not mix; parts of one do, which does no harm
        for (_, part, i, version, start, piece), found in zip(rows, _repeats_of(rows, length, letters), strict=True):
            if len(found):
                edge = np.flatnonzero(np.diff(found) > 1)
                for a, b in zip(found[np.concatenate(([0], edge + 1))].tolist(),
                                found[np.concatenate((edge, [len(found) - 1]))].tolist(), strict=True):
                    yield i, version, start + a, start + b, None
            if part:
                for a in np.setdiff1d(np.arange(len(piece) - length + 1), found).tolist():
                    yield i, version, start + a, None, piece[a:a + length]

    def run(batches):
        held: list = []
        size = 0
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "part", "doc_id", "version", "start", "bytes")),
                           strict=True):
                if size >= merge_bytes and row[:2] != held[-1][:2]:
                    yield from _merged(list(told(held)), id_type)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from _merged(list(told(held)), id_type)

    return run


def _merge_strings(length: int, letters: int, merge_bytes: int):
    """Intervals of one start each, as :func:`_merge_contexts` has them, for
    strings in order of key, the hash of their bytes.  A string whose key
    occurs once repeats nothing.  Where one key fills the memory allowed, only
    the strings that no other repeats are held on."""

    def run(batches):
        held: list = []
        limit = merge_bytes // length + 1
        id_type = None

        def settled():
            return [len(found) > 0 for found in _repeats_of(held, length, letters)] if len(held) > 1 else [False] * len(held)

        def told(repeat):
            return _merged([(i, v, a, a, None) for (_, i, v, a, _), r in zip(held, repeat, strict=True) if r], id_type)

        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.schema.field("doc_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "version", "first", "bytes")),
                           strict=True):
                if held and row[0] != held[-1][0]:
                    if len(held) == 1 or held[-2][0] != held[-1][0]:
                        held.pop()
                    if len(held) >= limit:
                        yield from told(settled())
                        held, limit = [], merge_bytes // length + 1
                elif len(held) >= limit:
                    repeat = settled()
                    yield from told(repeat)
                    held = [x for x, r in zip(held, repeat, strict=True) if not r]
                    limit = max(limit, 2 * len(held))
                held.append(row)
        if held:
            yield from told(settled())

    return run


def _cut_repeats(length: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for text, wanted in zip(part.column("text").to_pylist(), part.column("repeats").to_pylist(), strict=True):
                    data = (text or "").encode()
                    spans: list[list[int]] = []
                    for first, last in sorted((x["first"], x["last"]) for x in wanted or ()):
                        if spans and first <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], last + length)
                        else:
                            spans.append([first, last + length])
                    kept, done = [], 0
                    for a, b in spans:
                        kept.append(data[done:a])
                        done = b
                    kept = b"".join([*kept, data[done:]])
                    out.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
                columns = list(zip(*out, strict=True))
                spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(
                        columns, (pa.int64(), pa.int64(), spans_type, pa.binary()), strict=True))],
                    names=["doc_id", "n_bytes", "n_removed", "removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, merge_bytes: int = MERGE_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``removed`` (array of start,
    end: the maximal removed byte runs) and ``kept`` (binary: the other bytes)
    for every row of ``docs`` (doc_id, text).

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a document with a smaller id (null is smallest), or earlier in
    its own; overlaps count.  Texts are taken as UTF-8 bytes, null as empty;
    shorter ones lose nothing.  Rows that share an id are told apart by a hash
    of their texts, which orders them; rows with equal id and text are one
    document, which does not repeat itself, and get the same result.  An empty
    table gives no rows.

    ``length`` is a multiple of four, 52 to 128.  Different contexts are merged
    ``merge_bytes`` at a time, some 60 bytes of memory for each byte, however
    many one anchor has; equal contexts take one row from each input batch.
    """
    if length % LETTERS or not 52 <= length <= 128:
        raise ValueError("length must be a multiple of four from 52 to 128")
    shared = docs.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    version = F.xxhash64("text") if shared else F.lit(0).cast("long")
    texts = docs.select("doc_id", version.alias("version"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    single = texts  # one row a document: equal rows must not be taken for copies of each other
    if shared and texts.groupBy("doc_id", "version").count().where("count > 1").limit(1).count():
        single = staged(texts.dropDuplicates(["doc_id", "version"]), "documents")
    found = single.mapInArrow(
        _find_contexts(length), f"anchor long, context long, doc_id {kind}, version long, place long")
    told = staged(found.repartition("anchor")
                  .sortWithinPartitions("anchor", "context", "doc_id", "version", "place")
                  .mapInArrow(_compare_contexts(length, merge_bytes),
                              f"anchor long, part long, doc_id {kind}, version long, place long, repeat boolean"),
                  "contexts")

    def with_texts(texts: DataFrame, rows: DataFrame, name: str) -> DataFrame:
        """Each row of ``texts`` with its document's rows, gathered in the column ``name``."""
        gathered = (rows.groupBy("doc_id", "version").agg(F.collect_list(F.struct(
            *[c for c in rows.columns if c not in ("doc_id", "version")])).alias(name))
            .select(F.col("doc_id").alias("d"), F.col("version").alias("v"), name).hint("shuffle_hash"))
        return texts.join(gathered, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")),
                          "left").select("doc_id", "version", "text", name)

    unclear = with_texts(single, told.where("not repeat").select("doc_id", "version", "anchor", "part", "place"), "wanted")
    schema = f"doc_id {kind}, version long, first long, last long, bytes binary"
    merged = (unclear.mapInArrow(_cut_contexts(length),
                                 f"anchor long, part long, doc_id {kind}, version long, start long, bytes binary")
              .repartition("anchor", "part").sortWithinPartitions("anchor", "part")
              .mapInArrow(_merge_contexts(length, LETTERS, merge_bytes), schema))
    if told.where("part > 0").limit(1).count():
        merged = staged(merged, "merged")
        again = (merged.where("last is null").select(F.xxhash64("bytes").alias("key"), "doc_id", "version", "first", "bytes")
                 .repartition("key").sortWithinPartitions("key", "doc_id", "version", "first")
                 .mapInArrow(_merge_strings(length, LETTERS, merge_bytes), schema))
        merged = merged.where("last is not null").unionByName(again)
    merged = merged.drop("bytes")
    first = F.shiftright("place", 8)
    repeats = merged.unionByName(told.where("repeat").select(
        "doc_id", "version", first.alias("first"),
        (first + F.shiftright("place", 1).bitwiseAND(F.lit(127).cast("long"))).alias("last")))
    return with_texts(texts, repeats.dropDuplicates(), "repeats").mapInArrow(
        _cut_repeats(length),
        f"doc_id {kind}, n_bytes long, n_removed long, removed array<struct<start: long, end: long>>, kept binary")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op6_repeats": op6_repeats}
ORACLES: dict[str, str] = {}
