"""Stored tables: scan, rebuild, guarded append, merge, delete, compaction.

A keyed table is laid out in hash buckets of its key (a partition column), so
that a merge or delete reads and rewrites the buckets it touches and leaves the
rest alone.  Parquet has no transaction log: a rebuild is a new folder that is named when
it is whole, executors may come and go, but two writers at once are not supported.  Where the delta package is on the class path, ``fmt="delta"`` hands
merges and deletes to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quire.operators import merge as mg
from quire.operators.schema_guard import enforce_schema

BUCKET = "key_bucket"
# A stored row's fingerprint.  Two versions of a row that differ have equal ones with a chance of 1 in 2**64.
PRINT = "row_print"
TARGET_FILE_BYTES = 256 * 1024 * 1024


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each data file below a folder, by its path."""
    fs, p = _fs(spark, path)
    found, files = {}, fs.listFiles(p, True)
    while files.hasNext():
        status = files.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found[status.getPath().toString()] = status.getLen()
    return found


@dataclass(frozen=True)
class StoredTable:
    """A table at ``path``; with a ``key`` it is kept in ``buckets`` buckets.

    Choose ``buckets`` so that one bucket is a few files: about table size in
    GB for large tables.  It is fixed when the table is created.
    """

    spark: SparkSession
    path: str
    schema: T.StructType | None = None
    key: str | None = None
    buckets: int = 16
    fmt: str = "parquet"

    # -- versions --
    #
    # Each rebuild is a folder of its own, ``v<n>``.  An empty file of the same number in
    # ``_versions``, made when the folder is whole, names it; the largest one holds.

    def _versions(self) -> list[int]:
        return sorted(int(name) for name in child_names(self.spark, f"{self.path}/_versions") if name.isdigit())

    @property
    def _folder(self) -> str:
        if self.fmt == "delta":
            return self.path
        return f"{self.path}/v{max(self._versions(), default=0)}"

    # -- reading --

    def exists(self) -> bool:
        if self.fmt == "delta":
            return path_exists(self.spark, f"{self.path}/_delta_log")
        return bool(self._versions())

    def _stored(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}")
        reader = self.spark.read.format(self.fmt)
        if self.fmt == "parquet" and self.schema is not None:
            fields = [T.StructField(f.name, f.dataType) for f in self.schema]
            if self.key:
                fields += [T.StructField(PRINT, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
            reader = reader.schema(T.StructType(fields))
        return reader.load(self._folder)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET, PRINT)

    def count(self) -> int:
        return self._stored().count()

    # -- writing --

    @property
    def _bucketed(self) -> bool:
        return self.key is not None and self.fmt == "parquet"

    def _bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _declared(self, df: DataFrame) -> DataFrame:
        return df if self.schema is None else enforce_schema(df, self.schema)

    def _printed(self, df: DataFrame) -> DataFrame:
        """With a 64-bit fingerprint of each row, by which a merge knows rows that have not changed."""
        own = sorted(c for c in df.columns if c not in (PRINT, BUCKET))
        # Where a value is NULL counts: the hash itself passes over NULLs.
        parts = [F.col(c) for c in own] + [F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in own])]
        return df.select(*[c for c in df.columns if c not in (PRINT, BUCKET)], F.xxhash64(*parts).alias(PRINT))

    def _laid_out(self, df: DataFrame) -> DataFrame:
        """Rows next to their bucket; a bucket too large for one task is split."""
        if not self._bucketed:
            return df
        return self._printed(df).withColumn(BUCKET, self._bucket_of(F.col(self.key))).hint("rebalance", F.col(BUCKET))

    def _write(self, df: DataFrame, mode: str, folder: str | None = None, **options: str) -> None:
        writer = df.write.format(self.fmt).mode(mode).options(**options)
        if self._bucketed:
            writer = writer.partitionBy(BUCKET)
        writer.save(folder or self._folder)

    def rebuild(self, df: DataFrame) -> None:
        """Replace content and schema; a failed write leaves the table as it was."""
        if self.fmt == "delta":
            self._write(self._declared(df), "overwrite", overwriteSchema="true")
        else:
            self._new_version(self._laid_out(self._declared(df)))

    def append(self, df: DataFrame) -> None:
        """Add rows that have exactly the declared schema."""
        declared = self.schema
        if declared is None and self.exists():
            declared = T.StructType([T.StructField(f.name, f.dataType) for f in self.read().schema])
        guarded = df if declared is None else enforce_schema(df, declared)
        if self.fmt == "parquet" and not self.exists():
            self._new_version(self._laid_out(guarded))
        else:
            self._write(self._laid_out(guarded), "append")

    def _touched_buckets(self, rows: DataFrame) -> list[int]:
        """Bucket numbers occurring in ``rows``: at most ``buckets`` integers."""
        bucket = F.col(BUCKET) if BUCKET in rows.columns else self._bucket_of(F.col(self.key))
        return [r[0] for r in rows.select(bucket).distinct().collect()]

    def _replace_buckets(self, rows: DataFrame) -> None:
        """Make ``rows`` the whole content of the buckets they fall into."""
        self._write(self._laid_out(rows), "overwrite", partitionOverwriteMode="dynamic")

    # -- merge, delete, compaction --

    def merge(self, source: DataFrame, update_existing: bool) -> dict:
        """Insert new keys; with ``update_existing`` also replace known ones.

        The source should hold one row per key (``latest_revision``); rows that
        repeat a key are all inserted.  Rows that are stored as they come are counted as
        unchanged; buckets without other rows are not written.
        """
        source = self._declared(source)
        if not self.exists():
            self.rebuild(source)
            after = self.count()
            return {
                "rows_before": 0, "rows_incoming": after, "rows_inserted": after,
                "rows_updated": 0, "rows_unchanged": 0, "rows_after": after,
            }
        if self.fmt == "delta":
            return self._merge_delta(source, update_existing)

        from quire.session import materialize

        # The source is read more than once: fix it first.
        source = materialize(source, "merge-source")
        before, incoming = self.count(), source.count()
        counts = {"rows_before": before, "rows_incoming": incoming, "rows_inserted": 0, "rows_updated": 0, "rows_unchanged": 0}
        if incoming == 0:
            return counts | {"rows_after": before}
        target = self._stored()
        if self._bucketed:
            target = target.filter(F.col(BUCKET).isin(self._touched_buckets(source)))
        if not update_existing:
            new = mg.insert_only(target.drop(BUCKET, PRINT), source, self.key)
            self._write(self._laid_out(new), "append")
            after = self.count()
            return counts | {"rows_inserted": after - before, "rows_after": after}
        # Only keys and fingerprints of the target are read to find out what has changed.
        old, new = (target if self._bucketed else self._printed(target)), self._printed(source)
        changes = materialize(mg.changed_keys(old.select(self.key, PRINT), new.select(self.key, PRINT), self.key, PRINT), "merge-keys")
        n = changes.agg(
            F.coalesce(F.sum(F.when(F.col("n_target") == 0, F.col("n_source"))), F.lit(0)),
            F.coalesce(F.sum(F.when((F.col("n_target") > 0) & F.col("changed"), F.col("n_source"))), F.lit(0)),
        ).first()
        keys = changes.filter("changed").select(self.key)
        if n[0] or n[1]:
            rows = source.join(keys, source[self.key].eqNullSafe(keys[self.key]), "left_semi")
            if self._bucketed:
                touched = self._touched_buckets(keys)
                merged = mg.merge_upsert(target.filter(F.col(BUCKET).isin(touched)).drop(BUCKET, PRINT), rows, self.key)
                self._replace_buckets(merged)
            else:
                self._new_version(mg.merge_upsert(target, rows, self.key))
        return counts | {
            "rows_inserted": n[0], "rows_updated": n[1], "rows_unchanged": incoming - n[0] - n[1], "rows_after": self.count(),
        }

    def _merge_delta(self, source: DataFrame, update_existing: bool) -> dict:
        from delta.tables import DeltaTable

        before, incoming = self.count(), source.count()
        table = DeltaTable.forPath(self.spark, self.path)
        builder = table.alias("t").merge(source.alias("s"), f"t.{self.key} = s.{self.key}")
        if update_existing:
            builder = builder.whenMatchedUpdateAll()
        builder.whenNotMatchedInsertAll().execute()
        after = self.count()
        return {
            "rows_before": before, "rows_incoming": incoming, "rows_inserted": after - before,
            "rows_updated": incoming - (after - before) if update_existing else 0, "rows_unchanged": 0, "rows_after": after,
        }

    def delete_where(self, condition: Column) -> int:
        """Delete matching rows, rewriting only buckets that hold some."""
        before = self.count()
        if self.fmt == "delta":
            from delta.tables import DeltaTable

            DeltaTable.forPath(self.spark, self.path).delete(condition)
        elif not self._bucketed:
            self._new_version(mg.delete_where(self._stored(), condition))
        else:
            stored = self._stored()
            touched = self._touched_buckets(stored.filter(condition))
            self._keep(touched, mg.delete_where(stored.filter(F.col(BUCKET).isin(touched)), condition))
        return before - self.count()

    def delete_keys(self, keys: DataFrame) -> int:
        """Delete all rows of the given keys, rewriting only their buckets."""
        before, stored = self.count(), self._stored()
        keys = keys.select(F.col(self.key).alias("gone")).distinct()
        gone = F.col(self.key).eqNullSafe(F.col("gone"))
        if self.fmt == "delta":
            from delta.tables import DeltaTable

            table = DeltaTable.forPath(self.spark, self.path).alias("t")
            table.merge(keys.alias("s"), f"t.{self.key} <=> s.gone").whenMatchedDelete().execute()
        elif not self._bucketed:
            self._new_version(stored.join(keys, gone, "left_anti"))
        else:
            touched = self._touched_buckets(keys.select(F.col("gone").alias(self.key)))
            self._keep(touched, stored.filter(F.col(BUCKET).isin(touched)).join(keys, gone, "left_anti"))
        return before - self.count()

    def _keep(self, touched: list[int], rows: DataFrame) -> None:
        """Make ``rows`` the whole content of the touched buckets; those without rows go."""
        if not touched:
            return
        survivors = set(self._touched_buckets(rows))
        if survivors:
            self._replace_buckets(rows.drop(BUCKET, PRINT))
        for bucket in set(touched) - survivors:
            remove_folder(self.spark, f"{self._folder}/{BUCKET}={bucket}")

    def compact(self, target_file_bytes: int = TARGET_FILE_BYTES) -> None:
        """Same rows in files of about the wanted size, by the sizes of the files there are.

        Of a table in buckets only those are written again that have several files which fit
        into one, or a file of more than twice the size; the others keep their files.
        """
        if self.fmt == "delta":
            from delta.tables import DeltaTable

            DeltaTable.forPath(self.spark, self.path).optimize().executeCompaction()
            return
        stored, sizes = self._stored(), file_sizes(self.spark, self._folder)
        if not self._bucketed:
            self._new_version(stored.repartition(max(1, -(-sum(sizes.values()) // target_file_bytes))))
            return
        by_bucket: dict[int, list[int]] = {}
        for path, size in sizes.items():
            by_bucket.setdefault(int(path.rsplit(f"{BUCKET}=", 1)[1].split("/")[0]), []).append(size)
        pieces = {
            bucket: -(-sum(own) // target_file_bytes)
            for bucket, own in by_bucket.items()
            if files_after_packing(own, target_file_bytes) < len(own) or max(own) > 2 * target_file_bytes
        }
        if not pieces:
            return
        # A task for each file to come: the bucket's first one, and which of its rows go to the next ones.
        first, begin = {}, 0
        for bucket, n in sorted(pieces.items()):
            first[bucket], begin = begin, begin + n
        pairs = lambda numbers: F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
        bucket = F.col(BUCKET)
        share = F.pmod(F.xxhash64(*[F.col(c) for c in stored.columns if c != BUCKET]), F.element_at(pairs(pieces), bucket).cast("long"))
        place = (F.element_at(pairs(first), bucket) + share).cast("int")
        chosen = stored.filter(bucket.isin(list(pieces)))
        self._write(chosen.repartitionById(begin, place), "overwrite", partitionOverwriteMode="dynamic")

    def _new_version(self, df: DataFrame) -> None:
        """Write a folder of its own, then name it; a write that fails leaves the one before in place."""
        versions = self._versions()
        number = max(versions, default=0) + 1
        self._write(df, "overwrite", f"{self.path}/v{number}", partitionOverwriteMode="static")
        fs, name = _fs(self.spark, f"{self.path}/_versions/{number}")
        fs.create(name, False).close()
        # Who reads the version before may go on; older ones go.
        for old in versions[:-1]:
            fs.delete(_fs(self.spark, f"{self.path}/_versions/{old}")[1], False)
            remove_folder(self.spark, f"{self.path}/v{old}")


def files_after_packing(sizes: list[int], target: int) -> int:
    """Files that are left when small ones are put together up to ``target``: first fit, the largest first."""
    room: list[int] = []
    for size in sorted(sizes, reverse=True):
        for i, free in enumerate(room):
            if size <= free:
                room[i] -= size
                break
        else:
            room.append(max(0, target - size))
    return len(room)
