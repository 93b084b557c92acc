"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure, staged, work_dir

__all__ = ["add_columns", "connected_components", "kept_in_worker", "read_table", "set_aside", "staged", "work_dir"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for a registered query, whose session is configured with it
    (operators leave the session as it is)."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _forget(spark: SparkSession, path: str) -> None:
    """Delete a finished stage of the work area."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected graph given by columns ``a`` and ``b``.

    Returns ``(node, root)`` for every node that has an edge to another node;
    ``root`` is the component's smallest node.  Self-loops and repeated edges
    are ignored; no edges give no rows.

    Every round replaces the edges by large-star, then small-star edges: each
    neighbour is tied to the smallest node in sight, which halves distances, so
    rounds grow with the logarithm of the longest chain.  Minima are combined
    before the shuffle and staged, so that the joins are between plain shuffles,
    which adaptive execution splits where one hub holds most edges.  Each round
    is written to the shared work area; what it was made from is deleted.
    """
    spark = edges.sparkSession
    current = (edges.where("a <> b")
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    path = work_dir(spark, "components")
    current.write.parquet(path)
    schema, fingerprint = current.schema, None
    for _ in range(max_rounds):
        now = spark.read.schema(schema).parquet(path)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == fingerprint:
            break
        fingerprint = tuple(seen)
        # large-star: greater neighbours of u go to the smallest of u and its neighbours
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        made = [work_dir(spark, "minima") for _ in range(3)]

        def kept(df, at, made=made):
            df.write.parquet(made[at])
            return spark.read.schema(df.schema).parquet(made[at])

        low = kept(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), 0)
        large = kept(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                     .where("a <> b").distinct(), 1)
        # small-star: smaller neighbours of u, and u, go to the smallest of them (all edges here run from larger to smaller)
        least = kept(large.groupBy("a").agg(F.min("b").alias("low")), 2)
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
        following = work_dir(spark, "components")
        small.write.parquet(following)
        for done in (path, *made):
            _forget(spark, done)
        path = following
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = spark.read.schema(schema).parquet(path)
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def add_columns(df: DataFrame, inputs: list[str], fields: str, make, *args, held_bytes: int | None = None) -> DataFrame:
    """``df`` with the columns ``fields`` (DDL), computed in Arrow batches.

    ``make(*args)`` runs once in each task and returns a function that takes
    one row's ``inputs`` and returns the new columns' values as a tuple; with
    ``held_bytes`` one that takes a list of such rows, some ``held_bytes`` of
    them, and returns a list of tuples.  All other columns pass through
    untouched, under numbers, so that they may have any names; columns of ``df``
    that have one of the new names are replaced.
    """
    new = T.StructType.fromDDL(fields)
    names = df.columns
    kept = [i for i, c in enumerate(names) if c not in new.names]
    source = [names.index(c) for c in inputs]
    used = [*kept, *[i for i in dict.fromkeys(source) if i not in kept]]
    carried = df.toDF(*[f"c{i}" for i in range(len(names))]).select(*[f"c{i}" for i in used])
    schema = T.StructType([carried.schema[f"c{i}"] for i in kept]
                          + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(new)])
    at = [used.index(i) for i in source]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        begin_task()
        compute = make(*args)
        end_setup()

        def rows_of(part):
            return list(zip(*[part.column(i).to_pylist() for i in at], strict=True))

        def with_new(part, rows):
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(new)
            return pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(len(kept))]
                + [pa.array(list(v), type=f.type) for v, f in zip(columns, list(arrow)[len(kept):], strict=True)],
                names=schema.names)

        def together(parts):
            done = iter(compute([row for part in parts for row in rows_of(part)]))
            for part in parts:
                yield with_new(part, [next(done) for _ in range(part.num_rows)])

        held, size = [], 0
        for batch in batches:
            if held_bytes:
                held.append(batch)
                size += batch.nbytes
                if size >= held_bytes:
                    yield from together(held)
                    held, size = [], 0
                continue
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                yield with_new(part, [compute(*row) for row in rows_of(part)])
        if held:
            yield from together(held)
        pa.default_memory_pool().release_unused()

    return carried.mapInArrow(run, schema).toDF(*[names[i] for i in kept], *new.names)


# What a Python worker keeps from task to task: one thing at a time, so that
# the stages of a pipeline do not add up in one worker's memory.
_KEPT: dict = {}
_USED: list = []


def kept_in_worker(key, build):
    """The object ``build()`` made for ``key`` in an earlier task of this
    worker, or a new one, which takes the place of any other."""
    _USED.append(key)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def begin_task() -> None:
    _USED.clear()


def end_setup() -> None:
    """Let go of what an earlier stage has left, if this task keeps nothing."""
    if not _USED:
        _KEPT.clear()


def set_aside(df: DataFrame, *used: str):
    """``df`` with all columns but those named in ``used`` under numbers, so
    that an operator may use any other name itself, and a function that takes
    such a frame (with further columns) and returns ``df``'s columns again."""
    names = df.columns
    free = [c if c in used and names.index(c) == i else f"own_{i}" for i, c in enumerate(names)]
    return df.toDF(*free), lambda out: out.select(*free).toDF(*names)


#: Rows that add_columns turns into Python values at a time.  (Spark bounds the
#: batches it hands to Python by bytes.)
_ROWS = 128
