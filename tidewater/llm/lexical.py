"""Ranked lexical search by range maxima over posting lists.

Documents are dealt to shards; a shard has a posting list, in the order of its
documents, for each term of the queries, and over all lists one sparse table
that answers which posting of a range has the greatest impact.  The documents
of a shard are searched as intervals, best first: the sum of the lists' maxima
within an interval bounds the score of every document in it.  The interval with
the greatest bound is split at the document of its greatest impact, which is
scored exactly; what is left of it and right of it are new intervals.  Intervals
that cannot reach the k-th score so far are dropped, so the result is exact.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import begin_task, end_setup, read_table, staged
from .decontaminate import _word_chunks as term_chunks

TOP = 10
#: Bytes of query texts that are searched for together (their terms and weights
#: are broadcast, some 100 bytes of memory for each byte); more take another
#: pass, whose cost is little beside that of the searches.
QUERY_BYTES = 4 << 20
#: Postings of a shard: some 100 bytes of memory each, with the sparse table.
SHARD_POSTINGS = 1 << 19
#: Postings that one task searches, so that its time does not grow with the table.
TASK_POSTINGS = 1 << 20
#: Intervals that are split together, best ones first.
WIDTH = 32
#: Interval ends held for one query; beyond, intervals are split newest first,
#: which keeps few of them.
_CELLS = 1 << 22
_ROWS = 128
#: Ids kept of documents that are equal to the search, as a multiple of the ranks.
_SLACK = 4


def query_terms(text: str | None) -> list[bytes]:
    """The distinct terms of a text, sorted: runs of characters other than
    ASCII non-alphanumerics, only A-Z lower-cased."""
    return sorted({t for chunk in term_chunks(text or "") for t in chunk})


def term_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id``, ``n`` (all terms of the text, with repeats), ``terms`` and
    ``tfs``: numbers, in ``vocabulary`` (a broadcast dictionary of terms), of the
    terms that the text holds, ascending, and how often it holds each."""
    schema = T.StructType([docs.schema["doc_id"]] + T.StructType.fromDDL("n long, terms array<int>, tfs array<int>").fields)

    def run(batches):
        import pyarrow as pa

        begin_task()
        number = vocabulary.value.get
        end_setup()
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                lengths, ends, terms, tfs = [], [0], [], []
                for text in part.column(1).to_pylist():
                    n, held = 0, Counter()
                    for chunk in term_chunks(text or ""):
                        n += len(chunk)
                        held.update(map(number, chunk))
                    held.pop(None, None)
                    found = sorted(held.items())
                    terms += [t for t, _ in found]
                    tfs += [c for _, c in found]
                    lengths.append(n)
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64())]
                    + [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, tfs)],
                    names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Statistics:
    """Counts over all documents that scores are made of."""

    def __init__(self, documents: int, length: int, df: dict[int, int]):
        self.documents, self.length = documents, length
        self.weight = np.zeros(max(df, default=-1) + 1, np.int64)
        for term, n in df.items():
            self.weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))

    def damping(self, n: int) -> int:
        """8 m for a document of n terms."""
        return 8 * (10 + 90 * n * self.documents // self.length)


class Shard:
    """Posting lists of some documents and their sparse table.

    Documents with equal term counts have equal scores for every query; they
    are one entry with the smallest of their ids."""

    def __init__(self, top: int):
        self.top, self.postings = top, 0
        self.entries: dict[tuple[int, bytes, bytes], list] = {}

    def add(self, doc_id, n: int, terms: np.ndarray, tfs: np.ndarray) -> None:
        key = n, terms.tobytes(), tfs.tobytes()
        ids = self.entries.get(key)
        if ids is None:
            self.entries[key] = [(doc_id is None, doc_id)]
            self.postings += len(terms)
        else:
            ids.append((doc_id is None, doc_id))
            if len(ids) > _SLACK * self.top:
                ids.sort()
                del ids[self.top:]

    def build(self, statistics: Statistics) -> None:
        ids = [sorted(x)[:self.top] for x in self.entries.values()]
        terms = [np.frombuffer(t, np.int32) for _, t, _ in self.entries]
        sizes = np.array([len(t) for t in terms], np.int64)
        damping = np.repeat(np.array([statistics.damping(n) for n, _, _ in self.entries], np.int64), sizes)
        term = np.concatenate(terms).astype(np.int64)
        tf = np.concatenate([np.frombuffer(x, np.int32) for _, _, x in self.entries]).astype(np.int64)
        impact = statistics.weight[term] * (1_000_000_000 * tf // (1000 * tf + damping))
        entry = np.repeat(np.arange(len(sizes)), sizes)
        self.entries.clear()
        # Neighbours with the same strongest term make for tight bounds.
        strongest = np.lexsort((impact, entry))[np.cumsum(sizes) - 1]
        order = np.lexsort((-impact[strongest], term[strongest]))
        place = np.empty(len(sizes), np.int64)
        place[order] = np.arange(len(sizes))
        self.ids = [ids[k] for k in order]
        self.size = len(sizes)
        key = term * self.size + place[entry]
        by_key = np.argsort(key)
        self.key, self.impact = key[by_key], impact[by_key]
        last = int(term.max()) + 1
        self.start = np.searchsorted(self.key, np.arange(last + 1) * self.size)
        # Row k of the table: where, of the 2**k postings from here on, the greatest impact is.
        longest = int(np.diff(self.start).max())
        count = len(key)
        table = [np.arange(count, dtype=np.int32)]
        for k in range(1, longest.bit_length()):
            row, half = table[-1].copy(), 1 << (k - 1)
            a, b = table[-1][:-half], table[-1][half:]
            row[:-half] = np.where(self.impact[a] >= self.impact[b], a, b)
            table.append(row)
        self.table = np.concatenate(table)
        self.count = count
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, longest.bit_length()):
            self.log[1 << k:] = k

    def bounds(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of list ranges, the sum of their maxima and the posting
        of the greatest of them."""
        size = b - a
        some = size > 0
        k = self.log[size]
        first = self.table[np.where(some, k * self.count + a, 0)]
        second = self.table[np.where(some, k * self.count + b - (1 << k), 0)]
        left, right = self.impact[first], self.impact[second]
        greatest = np.where(some, np.maximum(left, right), 0)
        at = greatest.argmax(axis=1)[:, None]
        posting = np.where(left >= right, first, second)
        return greatest.sum(axis=1), np.take_along_axis(posting, at, 1)[:, 0]

    def search(self, terms: np.ndarray, best: list) -> None:
        """Bring this shard's documents into ``best``: at most ``top`` tuples
        (-score, id is null, id), sorted."""
        terms = terms[terms < len(self.start) - 1]
        terms = terms[self.start[terms] < self.start[terms + 1]]
        if not len(terms):
            return
        a, b = self.start[terms][None, :], self.start[terms + 1][None, :]
        bound, posting = self.bounds(a, b)
        base = terms * self.size
        while len(bound):
            if len(bound) <= WIDTH:
                now = np.arange(len(bound))
            elif a.size > _CELLS:
                now = np.arange(len(bound) - WIDTH, len(bound))
            else:
                now = np.argpartition(bound, -WIDTH)[-WIDTH:]
            low, high = a[now], b[now]
            place = self.key[posting[now]] % self.size
            wanted = base + place[:, None]
            at = np.searchsorted(self.key, wanted)
            there = (at < high) & (self.key[np.minimum(at, self.count - 1)] == wanted)
            scores = np.where(there, self.impact[np.minimum(at, self.count - 1)], 0).sum(axis=1)
            for k in np.argsort(-scores).tolist():
                score = int(scores[k])
                if not score or (len(best) == self.top and -score > best[-1][0]):
                    break
                for null, doc_id in self.ids[place[k]]:
                    insort(best, (-score, null, doc_id))
                del best[self.top:]
            least = -best[-1][0] if len(best) == self.top else 1
            new_a, new_b = np.concatenate((low, at + there)), np.concatenate((np.minimum(at, high), high))
            new_bound, new_posting = self.bounds(new_a, new_b)
            rest = bound >= least
            rest[now] = False
            new = new_bound >= least
            a, b = np.concatenate((a[rest], new_a[new])), np.concatenate((b[rest], new_b[new]))
            bound = np.concatenate((bound[rest], new_bound[new]))
            posting = np.concatenate((posting[rest], new_posting[new]))


def _search_shards(queries, statistics, top: int, shard_postings: int):
    def run(batches):
        import pyarrow as pa

        begin_task()
        wanted = [np.array(q, np.int64) for q in queries.value]
        counted = statistics.value
        end_setup()
        best: list[list] = [[] for _ in wanted]
        shard, kind = Shard(top), None

        def done():
            if shard.postings:
                shard.build(counted)
                for terms, found in zip(wanted, best, strict=True):
                    shard.search(terms, found)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids, lengths = batch.column("doc_id").to_pylist(), batch.column("n").to_numpy()
            lists = batch.column("terms")
            ends = lists.offsets.to_numpy()
            terms = lists.values.to_numpy()
            tfs = batch.column("tfs").values.to_numpy()  # has the same offsets
            for k, (s, e) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                if s < e:
                    shard.add(ids[k], int(lengths[k]), terms[s:e], tfs[s:e])
                    if shard.postings >= shard_postings:
                        done()
                        shard = Shard(top)
        done()
        rows = [(i, -s, d) for i, found in enumerate(best) for s, _, d in found]
        if rows:
            number, score, doc = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, kind)],
                names=["query", "score", "doc_id"])

    return run


def _search_block(docs: DataFrame, items: list, item_id: T.StructField, top: int, shard_postings: int) -> DataFrame:
    spark = docs.sparkSession
    texts = [query_terms(r["text"]) for r in items]
    vocabulary = {t: k for k, t in enumerate(sorted({t for terms in texts for t in terms}))}
    counted = staged(term_counts(docs, spark.sparkContext.broadcast(vocabulary)), "lexical-counts")
    seen = counted.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L"),
                       F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    df = counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # at most the vocabulary
    statistics = Statistics(seen["N"], seen["L"], {r["t"]: r["count"] for r in df})
    queries = [[vocabulary[t] for t in terms] for terms in texts]
    schema = T.StructType(T.StructType.fromDDL("query int, score long").fields + [docs.schema["doc_id"]])
    tasks = max(1, -(-seen["postings"] // TASK_POSTINGS))
    found = counted.where("size(terms) > 0").repartition(tasks).mapInArrow(
        _search_shards(spark.sparkContext.broadcast(queries), spark.sparkContext.broadcast(statistics), top,
                       shard_postings), schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(items)],
                                  T.StructType([T.StructField("query", T.IntegerType()), item_id]))
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, query_bytes: int = QUERY_BYTES,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: for each row of
    ``queries`` (item_id, text) its ``top`` documents of ``docs`` (doc_id, text)
    with the highest scores above 0, of equal scores those with smaller ids
    (null ids last).

    A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``; a document's score the
    sum over the query's distinct terms of ``w * (10**9 tf div (1000 tf + 8 m))``,
    with ``m = 10 + 90 n N div L``: N documents have terms, L terms in all, n in
    this document.  All documents are counted.  Null and empty texts have no
    terms, queries without terms or without a hit no rows.  Repeated rows of
    ``docs`` are documents, repeated rows of ``queries`` queries of their own.  Empty
    tables give no rows; other columns are not looked at.

    Texts are read once for each ``query_bytes`` of queries, whose total is
    counted first; the counts of the queries' terms are dealt out once, by
    documents, and every task hands on its best ``top`` of each query."""
    queries = queries.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = queries.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks, out = max(1, -(-total // query_bytes)), None
    for k in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        if block or (out is None and k == blocks - 1):
            part = _search_block(docs, block, queries.schema["item_id"], top, shard_postings)
            out = part if out is None else out.unionByName(part)
    return out


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
QUERIES = {"op11_lexical": op11_lexical}
ORACLES = {"op11_lexical": f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM lengths),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM tfs, whole GROUP BY term, nd),
damped AS (SELECT doc_id, 10 + (90 * n * nd) // nt AS m FROM lengths, whole),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN damped USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""}
