"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints a few bits apart have a common variant half-way: one that
each of them reaches by flipping at most half of those bits.  Every distinct
fingerprint emits its variants, equal variants meet in a shuffle, and the
fingerprints that meet are verified.

Half of an odd distance is no whole number.  The odd bit is taken up by
masking: the fingerprint is cut into blocks, and variants are emitted for each
block left out.  If two fingerprints differ, some block holds a differing bit;
leaving that one out, at most ``distance - 1`` bits are left to differ, and a
whole half of them on either side.  At distance 3 and with three blocks that
is 131 variants of radius 1, where unmasked balls would need radius 2 on one
side: 2081.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, connected_components, read_table, set_aside, staged

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCKS = 3
BITS = 64
#: Fingerprints whose variants one task emits.
TASK_PRINTS = 10_000

_CHUNK = 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def _word_lists(data: bytes, keep: int):
    """Lists of words, some megabyte of text at a time; each list but the
    first begins with the last ``keep`` words of the one before."""
    if len(data) <= _CHUNK:
        yield data.split()
        return
    words: list[bytes] = []
    for match in _WORD.finditer(data):
        words.append(match.group())
        if len(words) >= _CHUNK // 4:
            yield words
            words = words[len(words) - keep:] if keep else []
    yield words


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included.

    Bit i is set if it is set in over half of the shingles' XXH64 values.
    Texts of fewer words have one shingle, all of them; no words give zero."""
    data = (text or "").encode()
    # bytes.lower() and bytes.split() know ASCII letters and white space only
    data = data.lower()
    ones, count = np.zeros(BITS, np.int64), 0
    digest = xxhash.xxh64_intdigest
    for words in _word_lists(data, shingle - 1):
        if len(words) >= shingle:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        elif count or not words:
            continue
        else:
            shingles = [b" ".join(words)]
        h = np.array([digest(s, seed) for s in shingles], np.uint64)
        count += len(h)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = 2 * ones > count
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def _make_fingerprint(shingle, seed):
    def compute(text):
        value = fingerprint(text, shingle, seed)
        return (value - (1 << 64) if value >> 63 else value,)

    return compute


def flips(distance: int, blocks: int = BLOCKS) -> list[tuple[int, list[int]]]:
    """For each block, the mask that leaves it out and the bit patterns that
    turn a fingerprint into the variants within half of ``distance - 1`` of it.
    The left-out bits of the patterns carry the block's number, so that
    variants of different blocks do not meet."""
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    out = []
    for b, (start, end) in enumerate(zip(edges, edges[1:])):
        hole = ((1 << (end - start)) - 1) << start
        places = [i for i in range(BITS) if not hole >> i & 1]
        patterns = [sum(1 << i for i in some) | b << start for k in range(distance // 2 + 1)
                    for some in combinations(places, k)]
        out.append((~hole & ((1 << BITS) - 1), patterns))
    return out


def _emit(distance: int, blocks: int):
    balls = [(np.uint64(mask), np.array(patterns, np.uint64)) for mask, patterns in flips(distance, blocks)]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                prints = batch.column(0).slice(start, 4096).to_numpy().view(np.uint64)
                for mask, patterns in balls:
                    variants = (prints & mask)[:, None] ^ patterns
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(variants.reshape(-1).view(np.int64)),
                         pa.array(np.repeat(prints, len(patterns)).view(np.int64))], names=["variant", "fingerprint"])

    return run


def linked_forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between fingerprints at most ``distance`` bits apart, enough of
    them to join all that are joined: fingerprints are reached from one
    another, each is compared once with those not reached yet."""
    out, rest = [], np.unique(prints)
    queue: list[np.uint64] = []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        near = np.bitwise_count(rest ^ at) <= distance
        if near.any():
            found = rest[near]
            out += [(int(at), int(x)) for x in found]
            queue += list(found)
            rest = rest[~near]
    return out


def _verify(distance: int):
    """Verified links of fingerprints that follow one another with one variant."""

    def links(variants: np.ndarray, prints: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], variants[1:] != variants[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(variants)])))
        two = starts[sizes == 2]
        two = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance]
        found = set(zip(prints[two].tolist(), prints[two + 1].tolist(), strict=True))
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            found.update(linked_forest(prints[start:start + size], distance))
        both = np.array(sorted(found), np.uint64).reshape(-1, 2).view(np.int64)
        return both[:, 0], both[:, 1]

    def run(batches):
        import pyarrow as pa

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            variants = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy().view(np.uint64)
            if not len(variants):
                continue
            held.append((variants, prints))
            last = int(np.searchsorted(variants, variants[-1]))
            if last or (len(held) > 1 and held[-2][0][-1] != variants[-1]):
                # all but the last variant's fingerprints are complete
                done = [*held[:-1], (variants[:last], prints[:last])]
                held = [(variants[last:], prints[last:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in links(*map(np.concatenate, zip(*done, strict=True)))], names=["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in links(*map(np.concatenate, zip(*held, strict=True)))], names=["a", "b"])

    return run


def near_links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a``, ``b`` between the values of ``fingerprint`` (long, distinct)
    that join all fingerprints which are joined by steps of at most
    ``distance`` bits; every link is one such step.

    A meeting place holds fingerprints that agree, outside one block, with one
    variant but for half the distance, so its size is bounded by the block's
    width, not by the table.
    """
    tasks = max(1, -(-prints.count() // TASK_PRINTS))
    emitted = (prints.select("fingerprint").repartition(tasks)
               .mapInArrow(_emit(distance, blocks), "variant long, fingerprint long"))
    return (emitted.repartition("variant").sortWithinPartitions("variant")
            .mapInArrow(_verify(distance), "a long, b long").distinct())


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component`` (long: one of the
    group's fingerprints) for every row of ``docs`` (doc_id, text).

    Fingerprints link at ``distance`` or fewer differing bits; groups are what
    links join.  Equal fingerprints are one node, so copies cost one emission
    however many there are.  Null and empty texts, and those of blanks only,
    have fingerprint zero and group like any others.  Repeated rows and null
    ids are rows like any others; an empty table gives no rows.
    """
    marked = staged(add_columns(docs.select("doc_id", "text"), ["text"], "fingerprint long", _make_fingerprint,
                                shingle, seed).drop("text"), "simhash")
    links = near_links(staged(marked.select("fingerprint").distinct(), "simhash-prints"), distance)
    groups = connected_components(links).select(F.col("node").alias("fingerprint"), "root")
    return (marked.join(groups, "fingerprint", "left")
            .select("doc_id", "fingerprint", F.coalesce("root", "fingerprint").alias("component")))


def with_smallest_id(groups: DataFrame) -> DataFrame:
    """``groups`` with ``component_id``: the smallest doc_id of the component."""
    smallest = staged(groups.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    return groups.join(smallest, "component")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` (same columns) with one row of each group: that of the smallest
    doc_id (null ids last); of rows that share it, that with the smallest
    fingerprint, and of repeats of that any one.

    Where ids are unique, which a narrow count tells, they alone pick the rows
    and the texts are shuffled once; else fingerprints have to help."""
    groups = staged(simhash_groups(docs, shingle, distance), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")
    kept = (groups.groupBy("component").agg(F.min(first).alias("first"))
            .select(F.col("first.doc_id").alias("kept_id"), F.col("first.fingerprint").alias("kept_print")))
    free, own = set_aside(docs, "doc_id", "text")
    same_id = F.col("doc_id").eqNullSafe(F.col("kept_id"))
    if not groups.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return own(free.join(kept, same_id, "left_semi"))
    marked = add_columns(free, ["text"], "print long", _make_fingerprint, shingle, SEED)
    chosen = marked.join(kept, same_id & (F.col("print") == F.col("kept_print")), "left_semi")
    return own(chosen.dropDuplicates(["doc_id", "print"]))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = with_smallest_id(simhash_groups(read_table(spark, sf_dir, "documents")))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op3_simhash": op3_simhash}
ORACLES: dict[str, str] = {}
