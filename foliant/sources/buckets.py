"""Bucketed generations: a change rewrites only the buckets that it touches.

Tables (``parts``) are split by a hash of their id into ``n_buckets`` folders. A
manifest per generation names, for every part and bucket, the generation that wrote
it last; a commit writes the touched buckets into a folder of the new generation
and then the manifest, so a generation counts once its manifest stands, and an
aborted one leaves only folders that no manifest names. The last two manifests are
kept; bucket folders that neither names are removed.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliant.sources import store as ST

MANIFEST = "part string, bucket int, gen int"


class BucketStore:
    """Tables of the given schemas, all with the column ``id``, under one base folder."""

    def __init__(self, spark: SparkSession, base: str, schemas: dict[str, StructType], n_buckets: int = 64):
        self.spark, self.base, self.schemas, self.n_buckets = spark, base.rstrip("/"), schemas, n_buckets

    def bucket(self, column: str | Column = "id") -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.n_buckets)).cast("int")

    def buckets_of(self, ids: DataFrame, column: str = "id") -> list[int]:
        """The buckets of the ids; at most ``n_buckets`` numbers."""
        return sorted(r["b"] for r in ids.where(F.col(column).isNotNull()).select(self.bucket(column).alias("b")).distinct().collect())

    def generations(self) -> list[int]:
        done = []
        for gen in ST.list_generations(self.spark, f"{self.base}/manifest"):
            if ST._exists(self.spark, f"{self.base}/manifest/gen={gen}/_SUCCESS"):
                done.append(gen)
        return done

    def manifest(self, gen: int | None = None) -> dict[tuple[str, int], int]:
        """(part, bucket) -> generation that wrote it; buckets without rows are left out."""
        if gen is None:
            gens = self.generations()
            if not gens:
                return {}
            gen = gens[-1]
        rows = self.spark.read.schema(MANIFEST).json(f"{self.base}/manifest/gen={gen}").collect()
        return {(r["part"], r["bucket"]): r["gen"] for r in rows}

    def _folder(self, part: str, gen: int, bucket: int) -> str:
        return f"{self.base}/{part}/gen={gen}/bucket={bucket}"

    def read(self, part: str, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a part, of all buckets or of the given ones only."""
        named = self.manifest()
        wanted = range(self.n_buckets) if buckets is None else buckets
        paths = [self._folder(part, named[part, b], b) for b in wanted if (part, b) in named]
        if not paths:
            return self.spark.createDataFrame([], self.schemas[part])
        return self.spark.read.schema(self.schemas[part]).parquet(*paths)

    def commit(self, tables: dict[str, tuple[DataFrame, list[int] | None]]) -> int:
        """Write a generation. ``tables``: by part, the whole new content of the buckets in the
        list (None: of all); parts and buckets that are not named stay as they are."""
        gens = self.generations()
        every = ST.list_generations(self.spark, f"{self.base}/manifest")
        gen = max([0, *every]) + 1
        named = self.manifest(gens[-1]) if gens else {}
        for part, (df, buckets) in tables.items():
            touched = list(range(self.n_buckets)) if buckets is None else buckets
            path = f"{self.base}/{part}/gen={gen}"
            cols = self.schemas[part].fieldNames()
            df.select(*cols, self.bucket().alias("bucket")).repartition(F.col("bucket")) \
                .write.mode("overwrite").partitionBy("bucket").parquet(path)
            for b in touched:
                if ST._exists(self.spark, self._folder(part, gen, b)):
                    named[part, b] = gen
                else:
                    named.pop((part, b), None)
        rows = [(part, b, g) for (part, b), g in sorted(named.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.base}/manifest/gen={gen}")
        self._clean([*gens, gen][-2:])
        return gen

    def _clean(self, keep: list[int]) -> None:
        """Remove manifests but ``keep``, and bucket folders that these do not name."""
        used = defaultdict(set)
        for gen in keep:
            for (part, b), g in self.manifest(gen).items():
                used[part, g].add(b)
        for gen in ST.list_generations(self.spark, f"{self.base}/manifest"):
            if gen not in keep:
                ST._delete(self.spark, f"{self.base}/manifest/gen={gen}")
        for part in self.schemas:
            for gen in ST.list_generations(self.spark, f"{self.base}/{part}"):
                names = used.get((part, gen), set())
                if not names:
                    ST._delete(self.spark, f"{self.base}/{part}/gen={gen}")
                    continue
                fs, path = ST._fs(self.spark, f"{self.base}/{part}/gen={gen}")
                for st in fs.listStatus(path):
                    name = st.getPath().getName()
                    if name.startswith("bucket=") and int(name[7:]) not in names:
                        fs.delete(st.getPath(), True)
