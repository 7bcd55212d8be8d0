"""A table that only grows, with each key once, over retries, restarts and streams.

**Commit.** A batch is written to a segment folder of its own first. Then a manifest that names the segment is written beside the
others and renamed to the batch's name in one step; readers go by manifests, so a segment whose writer died before that step
is not there, and a batch that was committed is not committed again.

**Keys.** Rows whose key an earlier segment holds are left out. Every segment comes with a bitmap of its key hashes, ``bits`` long. The
bitmaps of all segments are joined into one of that size, whatever number of segments there is; only arriving rows whose bit is
set meet the stored keys in a join. A bit that two keys share costs a comparison and never a row.

One writer at a time appends to a ledger; of two that commit the same batch, the second finds it done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from keepwell.operators.constraints import keep_one_per_key
from keepwell.session import settle

# Bits of the bitmap: 32 MB in 8192 rows, and one key in four collides at about 70 million keys.
BITS = 1 << 28
_BUCKET = 8 * 4096


class Ledger:
    """The ledger in ``folder``, which every executor reaches. ``schema`` is that of its rows, ``key`` their key."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: Sequence[str], bits: int = BITS):
        if bits % _BUCKET:
            raise ValueError(f"bits come in multiples of {_BUCKET}")
        self.spark, self.folder, self.schema, self.key, self.bits = spark, folder.rstrip("/"), schema, list(key), bits
        jvm, context = spark.sparkContext._jvm, spark.sparkContext
        self._paths = jvm.org.apache.hadoop.fs.Path
        home = self._paths(self.folder)
        self._files = home.getFileSystem(context._jsc.hadoopConfiguration())
        home = self._files.makeQualified(home)
        self._names = jvm.org.apache.hadoop.fs.FileContext.getFileContext(home.toUri(), context._jsc.hadoopConfiguration())
        self._no_options = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    # -- manifests --------------------------------------------------------------------------------------

    def _manifest(self, batch: str) -> str:
        return f"{self.folder}/commits/{batch}.json"

    def committed(self, batch: str) -> bool:
        return self._files.exists(self._paths(self._manifest(batch)))

    def segments(self) -> list[str]:
        """Folders of the committed segments, in the order of their batches."""
        home = self._paths(f"{self.folder}/commits")
        if not self._files.exists(home):
            return []
        names = sorted(s.getPath().getName() for s in self._files.listStatus(home))
        return [json.loads(self._read(f"{self.folder}/commits/{n}"))["segment"] for n in names if n.endswith(".json")]

    def _read(self, path: str) -> str:
        stream = self._files.open(self._paths(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _publish(self, batch: str, manifest: dict) -> bool:
        """Make the manifest visible under the batch's name; false if there is one already."""
        draft = self._paths(f"{self.folder}/drafts/{uuid.uuid4().hex}")
        stream = self._files.create(draft)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        final = self._paths(self._manifest(batch))
        self._files.mkdirs(final.getParent())
        if self._files.exists(final):
            self._files.delete(draft, False)
            return False
        self._names.rename(self._files.makeQualified(draft), self._files.makeQualified(final), self._no_options)
        return True

    # -- rows -------------------------------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """All committed rows."""
        return self.spark.read.schema(self.schema).parquet(*[f"{s}/rows" for s in found]) if (found := self.segments()) else self.spark.createDataFrame([], self.schema)

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.bits))

    def _bitmap(self, rows: DataFrame) -> DataFrame:
        """``bucket, bitmap`` of the keys; one row of 4096 bytes for each bucket with a key."""
        place = rows.select(self._place().alias("place"))
        bucket = F.bitmap_bucket_number(F.col("place")).alias("bucket")
        return place.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place"))).alias("bitmap"))

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose key no committed segment holds."""
        found = self.segments()
        if not found:
            return rows
        bitmaps = self.spark.read.schema("bucket long, bitmap binary").parquet(*[f"{s}/keys" for s in found])
        whole = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("_bitmap")).withColumnRenamed("bucket", "_bucket")
        at = F.bitmap_bit_position(self._place())
        named = rows.withColumns({"_of": F.bitmap_bucket_number(self._place()), "_at": at})
        met = named.join(whole, F.col("_of") == F.col("_bucket"), "left")
        byte = F.conv(F.hex(F.substring("_bitmap", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.expr("shiftright(_byte, CAST(_at % 8 AS INT)) & 1")
        marked = settle(met.withColumn("_byte", F.coalesce(byte, F.lit(0))).withColumn("_maybe", bit == 1).select(*rows.columns, "_maybe"))
        known = self.rows().select(*self.key).distinct()
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.key]
        condition = same[0]
        for more in same[1:]:
            condition = condition & more
        again = marked.filter("_maybe").alias("n").join(known.alias("k"), condition, "left_anti")
        return marked.filter(~F.col("_maybe")).unionByName(again).drop("_maybe")

    def commit(self, batch: str, rows: DataFrame, order: Sequence[str] = ()) -> bool:
        """Append the rows of a batch that are new, one per key (the first by ``order``); false if the batch was committed before.

        An interrupted call leaves nothing that readers see, and may be repeated with the same batch name.
        """
        if self.committed(batch):
            return False
        segment = f"{self.folder}/segments/{batch}-{uuid.uuid4().hex}"
        rest = [c for c in rows.columns if c not in self.key]
        first = keep_one_per_key(rows, self.key, list(order) or rest or self.key, keep="first") if rest else rows.distinct()
        self.unseen(first).select(*self.schema.names).write.parquet(f"{segment}/rows")
        written = self.spark.read.schema(self.schema).parquet(f"{segment}/rows")
        self._bitmap(written).write.parquet(f"{segment}/keys")
        return self._publish(batch, {"segment": segment, "batch": batch})

    def sweep(self) -> int:
        """Delete segments that no manifest names, left by writers that died; returns how many. No writer may be at work."""
        home = self._paths(f"{self.folder}/segments")
        if not self._files.exists(home):
            return 0
        kept = {s.rsplit("/", 1)[1] for s in self.segments()}
        stale = [s.getPath() for s in self._files.listStatus(home) if s.getPath().getName() not in kept]
        for path in stale:
            self._files.delete(path, True)
        return len(stale)
