"""Build, validate, finalise and publish a feature table.

A build writes Parquet, partitioned by symbol, timeframe and year, into a folder of its
own under the root, and keeps a fingerprint of each sequence's bars beside it: a build
that is resumed skips only sequences whose bars and rows are still those.  Finalising
computes every column anew and compares it bit for bit, checks that the bars did not
change meanwhile, and writes a READY record that seals counts, schema, bars and files.
Publishing adds a pointer file with the next number; the highest number counts, so
readers see either the old table or the new one, a second publisher at the same
time fails, and a rollback adds a pointer too.  Control records are small JSON texts, moved
into place by Hadoop's file system, so any store that Spark writes to will do.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.registry import FAMILIES, select
from ..sources.bars import KEYS, TIME, fingerprint
from ..sources.files import changed, digest_tree
from . import audit, states
from .features import compute


class PublishError(RuntimeError):
    pass


class Store:
    """Small text files beside the data."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, jvm = root.rstrip("/"), spark._jvm
        fs, conf = jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._path = fs.Path
        self._fs = self._path(self.root).getFileSystem(conf)
        self._files = fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)
        self._rename = getattr(fs, "Options$Rename")
        self._array = lambda x: spark.sparkContext._gateway.new_array(self._rename, 1)
        self._io = jvm.org.apache.hadoop.io.IOUtils
        self._buffer = jvm.java.io.ByteArrayOutputStream

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def read(self, name: str) -> dict:
        source, buffer = self._fs.open(self._path(f"{self.root}/{name}")), self._buffer()
        try:
            self._io.copyBytes(source, buffer, 4096, False)
        finally:
            source.close()
        return json.loads(bytes(buffer.toByteArray()))

    def write(self, name: str, value: dict, overwrite: bool = False) -> None:
        """Write beside and move in one step: never a half file under the name, nor none where one was."""
        part = self._path(f"{self.root}/.{name}.{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        try:
            out.write(bytearray(canonical(value)))
        finally:
            out.close()
        how = self._array(1)
        how[0] = self._rename.OVERWRITE if overwrite else self._rename.NONE
        try:
            self._files.rename(part, self._path(f"{self.root}/{name}"), how)
        except Py4JJavaError as e:
            self._fs.delete(part, False)
            raise PublishError(f"cannot move {name} into place; is it there already?") from e

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def files(self, folder: str) -> list[tuple[str, int]]:
        """Names and sizes of all data files below a folder."""
        found, files = [], self._fs.listFiles(self._path(f"{self.root}/{folder}"), True)
        while files.hasNext():
            f = files.next()
            if f.getPath().getName().endswith(".parquet"):
                found.append((f.getPath().toString().rsplit(f"/{folder}/", 1)[-1], f.getLen()))
        return sorted(found)


def keep_tree(spark: SparkSession, root: str, run: str) -> str:
    """Write the digest tree of a build's files; gives the root's digest."""
    tree = digest_tree(spark, f"{root}/builds/{run}")
    tree.write.mode("overwrite").parquet(f"{root}/trees/{run}")
    return kept_tree(spark, root, run).where("level = 'root'").first().digest


def kept_tree(spark: SparkSession, root: str, run: str) -> DataFrame:
    return spark.read.parquet(f"{root}/trees/{run}")


def contents(spark: SparkSession, root: str, run: str) -> str:
    """The root's digest of a build's files as they are now."""
    return digest_tree(spark, f"{root}/builds/{run}").where("level = 'root'").first().digest


def canonical(value: dict) -> bytes:
    return json.dumps(value, sort_keys=True, separators=(",", ":")).encode()


def digest(value: dict) -> str:
    return hashlib.sha256(canonical(value)).hexdigest()


def build(bars: DataFrame, root: str, run: str, *, families: tuple[str, ...] = FAMILIES, columns: list[str] | None = None, resume: bool = False) -> DataFrame:
    """Write the features of all sequences to root/builds/run; one plan, no loop over sequences.

    resume computes the sequences that are not there yet, and anew those whose bars are
    not the fingerprinted ones or whose rows are not as many as their bars.
    """
    spark = bars.sparkSession
    path, store = f"{root}/builds/{run}", Store(spark, root)
    wanted = digest({"c": list(select(columns, families))})
    prints = fingerprint(bars).withColumn("columns", F.lit(wanted))
    there = store.exists(f"builds/{run}")
    if there and not resume:
        raise PublishError(f"build {run} is there already")
    if there:
        # Written, as what it was read from is about to change.
        skipped = f"{root}/skipped/{run}-{uuid.uuid4().hex}"
        valid_sequences(spark, root, run, prints).write.parquet(skipped)
        valid = spark.read.parquet(skipped)
        bars = bars.join(valid, list(KEYS), "left_anti")
        prints = prints.join(valid, list(KEYS), "left_anti")
        for r in stored(spark, root, run).select(*KEYS).distinct().join(valid, list(KEYS), "left_anti").collect():  # names of sequences
            store.remove(f"builds/{run}/symbol={_escaped(r.symbol)}/timeframe={_escaped(r.timeframe)}")
    made = compute(bars, families=families, columns=columns).withColumn("year", F.year(TIME))
    made.repartition("symbol", "timeframe", "year").sortWithinPartitions(TIME).write.mode("append" if there else "errorifexists").partitionBy("symbol", "timeframe", "year").option("compression", "zstd").parquet(path)
    prints.withColumn("stamp", F.current_timestamp()).write.mode("append").parquet(f"{root}/prints/{run}")
    keep_tree(spark, root, run)
    return stored(spark, root, run)


def keep_pasts(bars: DataFrame, root: str, run: str, *, families: tuple[str, ...] = FAMILIES, columns: list[str] | None = None) -> None:
    """Write what new bars need to go on from a build: the first version of its pasts, by one pass over its bars."""
    _, pasts = states.advance(bars, None, families=families, columns=columns)
    pasts.write.parquet(f"{root}/pasts/{run}/version={1:08d}")


def branch(spark: SparkSession, root: str, base: str, run: str) -> None:
    """A new build with the rows, fingerprints and last pasts of another: finalised builds are never changed.

    Rows are copied by a job over the table, nothing is computed.
    """
    store = Store(spark, root)
    if store.exists(f"builds/{run}"):
        raise PublishError(f"build {run} is there already")
    versions = [n for n in store.names(f"pasts/{base}") if store.exists(f"pasts/{base}/{n}/_SUCCESS")]
    if not versions:
        raise PublishError(f"no pasts are kept for build {base}")
    stored(spark, root, base).repartition("symbol", "timeframe", "year").sortWithinPartitions(TIME).write.partitionBy("symbol", "timeframe", "year").option("compression", "zstd").parquet(f"{root}/builds/{run}")
    spark.read.parquet(f"{root}/prints/{base}").write.parquet(f"{root}/prints/{run}")
    spark.read.parquet(f"{root}/pasts/{base}/{versions[-1]}").write.parquet(f"{root}/pasts/{run}/{versions[-1]}")


def append(bars: DataFrame, root: str, run: str, *, families: tuple[str, ...] = FAMILIES, columns: list[str] | None = None) -> DataFrame:
    """Add new bars' features to a build whose pasts were kept; reads no older bar.

    Rows, fingerprints and the next version of the pasts are written in this order, under a
    journal with the files before: an append that broke off is undone by the next one, which
    then begins again.  The build is to be finalised as any other, over all bars.
    """
    spark = bars.sparkSession
    store = Store(spark, root)
    if store.exists(f"ready-{run}.json"):
        raise PublishError(f"build {run} is finalised; branch from it")
    versions = [n for n in store.names(f"pasts/{run}") if store.exists(f"pasts/{run}/{n}/_SUCCESS")]
    if not versions:
        raise PublishError(f"no pasts are kept for build {run}")
    number = int(versions[-1].removeprefix("version=")) + 1
    journal, path = f"append-{run}-{number:08d}.json", f"{root}/pasts/{run}/version={number:08d}"
    folders = [f"builds/{run}", f"prints/{run}"]
    if store.exists(journal):
        was = store.read(journal)["files"]
        for folder in folders:
            for name, _ in store.files(folder):
                if name not in set(was[folder]):
                    store.remove(f"{folder}/{name}")
        store.remove(f"pasts/{run}/version={number:08d}")
    else:
        store.write(journal, {"files": {f: [n for n, _ in store.files(f)] for f in folders}})
    pasts = spark.read.schema(states.Split(columns, families).schema).parquet(f"{root}/pasts/{run}/{versions[-1]}")
    made, after = states.advance(bars, pasts, families=families, columns=columns)
    made.withColumn("year", F.year(TIME)).repartition("symbol", "timeframe", "year").sortWithinPartitions(TIME).write.mode("append").partitionBy("symbol", "timeframe", "year").option("compression", "zstd").parquet(f"{root}/builds/{run}")
    _merged_prints(spark, root, run, fingerprint(bars)).withColumn("columns", F.lit(digest({"c": list(select(columns, families))}))).withColumn("stamp", F.current_timestamp()).write.mode("append").parquet(f"{root}/prints/{run}")
    keep_tree(spark, root, run)
    after.write.parquet(path)
    return stored(spark, root, run)


def _merged_prints(spark: SparkSession, root: str, run: str, new: DataFrame) -> DataFrame:
    """Fingerprints of sequences with new bars, from the last ones and those of the new bars alone."""
    fields = ["n_bars", "first_time", "last_time", "hash_sum", "hash_xor"]
    last = spark.read.schema(T.StructType([*new.schema.fields, T.StructField("stamp", T.TimestampType())])).parquet(f"{root}/prints/{run}")
    last = last.groupBy(*KEYS).agg(F.max(F.struct("stamp", *fields)).alias("was")).select(*KEYS, *[F.col(f"was.{c}").alias(c) for c in fields])
    both = last.join(new.select(*KEYS), list(KEYS), "left_semi").unionByName(new)
    return both.groupBy(*KEYS).agg(F.sum("n_bars").alias("n_bars"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("string").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))


def _escaped(value: str) -> str:
    """A partition value as Spark names its folder."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or ord(c) < 32 else c for c in value)


def valid_sequences(spark: SparkSession, root: str, run: str, prints: DataFrame) -> DataFrame:
    """Sequences of a build whose last fingerprint is that of their bars now, with as many rows as bars."""
    if not Store(spark, root).exists(f"prints/{run}"):
        return prints.select(*KEYS).limit(0)
    same = ["n_bars", "first_time", "last_time", "hash_sum", "hash_xor", "columns"]
    last = spark.read.schema(T.StructType([*prints.schema.fields, T.StructField("stamp", T.TimestampType())])).parquet(f"{root}/prints/{run}")
    last = last.groupBy(*KEYS).agg(F.max(F.struct("stamp", *same)).alias("was")).select(*KEYS, "was")
    rows = stored(spark, root, run).groupBy(*KEYS).agg(F.count("*").alias("rows"))
    now = prints.select(*KEYS, F.struct(*same).alias("now"), F.col("n_bars").alias("expected"))
    matches = [F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}")) for c in same]
    condition = F.col("rows") == F.col("expected")
    for m in matches:
        condition = condition & m
    valid = now.join(last, list(KEYS)).join(rows, list(KEYS)).where(condition).select(*KEYS)
    if Store(spark, root).exists(f"trees/{run}/_SUCCESS"):
        # Sequences whose files are not byte by byte those that were written.
        other = changed(kept_tree(spark, root, run), digest_tree(spark, f"{root}/builds/{run}")).where("level = 'sequence'")
        valid = valid.join(other.select(*KEYS), list(KEYS), "left_anti")
    return valid


def stored(spark: SparkSession, root: str, run: str) -> DataFrame:
    """A build's rows; its partition columns are strings, as symbols are codes: `01` is not `1`."""
    path = f"{root}/builds/{run}"
    found = spark.read.option("mergeSchema", False).parquet(path).schema
    text = {f.name: T.StringType() for f in found if f.name in KEYS}
    return spark.read.schema(T.StructType([T.StructField(f.name, text.get(f.name, f.dataType)) for f in found])).parquet(path)


def structure(bars: DataFrame, features: DataFrame, *, families: tuple[str, ...] = FAMILIES, columns: list[str] | None = None) -> dict:
    """Columns and bars that are missing or too many; one join over the keys."""
    wanted = list(select(columns, families))
    have = [c for c in features.columns if c not in (*KEYS, TIME, "year")]
    on = [*KEYS, TIME]
    a, b = (x.groupBy(*on).agg(F.count("*").alias(n)) for x, n in ((bars, "x"), (features, "y")))
    gap = F.coalesce("x", F.lit(0)) - F.coalesce("y", F.lit(0))
    row = a.join(b, on, "full_outer").agg(F.sum(F.greatest(gap, F.lit(0))), F.sum(F.greatest(-gap, F.lit(0)))).first()
    return {"columns_missing": [c for c in wanted if c not in have], "columns_extra": [c for c in have if c not in wanted], "bars_missing": row[0] or 0, "bars_extra": row[1] or 0}


def validate(bars: DataFrame, features: DataFrame, **scope) -> dict:
    """Structure, then every cell against one that is computed anew: cells, and those that are not identical."""
    report = structure(bars, features, **scope)
    if any(report.values()):
        return report | {"cells": 0, "not_identical": 0}
    row = audit.compare(features.drop("year"), compute(bars, **scope), absolute=0.0, relative=0.0).agg(F.sum("n_cells"), F.sum("not_identical")).first()
    return report | {"cells": row[0] or 0, "not_identical": row[1] or 0}


def _seal(bars: DataFrame) -> dict:
    """Counts of the bars and a digest over the fingerprints of all sequences."""
    rows = fingerprint(bars)
    h = F.xxhash64(*KEYS, "n_bars", "first_time", "last_time", "hash_sum", "hash_xor")
    n, total, x, y = rows.agg(F.count("*"), F.sum("n_bars"), F.sum(h.cast("decimal(38,0)")).cast("string"), F.bit_xor(h)).first()
    return {"sequences": n, "bars": total or 0, "source": digest({"sum": x, "xor": y})}


def finalize(bars: DataFrame, root: str, run: str, **scope) -> dict:
    """Validate all cells and write READY last; gives the record.

    The bars must be those of the build's fingerprints, and be the same before and after.
    """
    spark = bars.sparkSession
    before, files = _seal(bars), contents(spark, root, run)
    prints = fingerprint(bars).withColumn("columns", F.lit(digest({"c": list(select(scope.get("columns"), scope.get("families", FAMILIES)))})))
    if valid_sequences(spark, root, run, prints).count() != before["sequences"]:
        raise PublishError(f"build {run} was not made from these bars and columns, or is not complete")
    report = validate(bars, stored(spark, root, run), **scope)
    if any(v for k, v in report.items() if k != "cells"):
        raise PublishError(f"build {run} is not valid: {report}")
    if _seal(bars) != before or contents(spark, root, run) != files:
        raise PublishError("bars or files changed while they were validated")
    ready = {"run": run, "columns": list(select(scope.get("columns"), scope.get("families", FAMILIES))), "cells": report["cells"], "files": files, **before}
    Store(spark, root).write(f"ready-{run}.json", ready)
    return ready


def pointer(store: Store) -> tuple[int, dict | None]:
    """The number and content of the pointer that counts; 0 and none before the first."""
    names = [n for n in store.names("") if n.startswith("current-") and n.endswith(".json")]
    return (int(names[-1][8:-5]), store.read(names[-1])) if names else (0, None)


def publish(spark: SparkSession, root: str, run: str, *, confirm: str | None = None) -> dict:
    """Point readers to a finalised build; without `confirm`, the READY digest, only tell what would be done."""
    store = Store(spark, root)
    if not store.exists(f"ready-{run}.json"):
        raise PublishError(f"build {run} is not finalised")
    record = store.read(f"ready-{run}.json")
    ready, (number, now) = digest(record), pointer(store)
    plan = {"run": run, "ready": ready, "previous": now["run"] if now else None}
    if confirm is None:
        return plan | {"published": False}
    if confirm != ready:
        raise PublishError("the confirmed digest is not that of READY")
    if contents(spark, root, run) != record["files"]:
        raise PublishError(f"the files of build {run} are not those that were validated")
    journal = {"run": run, "ready": ready, "number": number + 1}
    store.write(f"journal-{number + 1:08d}-{run}.json", journal | {"state": "PREPARED"}, overwrite=True)
    store.write(f"current-{number + 1:08d}.json", {"run": run, "ready": ready, "history": [*now["history"], now["run"]] if now else []})
    store.write(f"journal-{number + 1:08d}-{run}.json", journal | {"state": "LIVE"}, overwrite=True)
    return plan | {"published": True}


def current(spark: SparkSession, root: str) -> DataFrame:
    _, now = pointer(Store(spark, root))
    if now is None:
        raise PublishError("nothing is published")
    return stored(spark, root, now["run"])


def verify_live(bars: DataFrame, root: str, **scope) -> dict:
    """What is published against its READY record and, cell by cell, against its bars; gives the report."""
    spark = bars.sparkSession
    store = Store(spark, root)
    _, now = pointer(store)
    if now is None:
        raise PublishError("nothing is published")
    record = store.read(f"ready-{now['run']}.json")
    report = validate(bars, stored(spark, root, now["run"]), **scope)
    found = {"ready": digest(record) == now["ready"], "files": contents(spark, root, now["run"]) == record["files"], "bars": _seal(bars)["source"] == record["source"], "cells": not any(v for k, v in report.items() if k != "cells")}
    return {"run": now["run"], "status": "PASS" if all(found.values()) else "FAIL", **found, "report": report}


def recover(spark: SparkSession, root: str) -> list[str]:
    """Close publications that broke off: LIVE if their pointer was written, UNDONE if not; gives what was done."""
    store, done = Store(spark, root), []
    for name in store.names(""):
        if name.startswith("journal-") and name.endswith(".json"):
            entry = store.read(name)
            if entry["state"] == "PREPARED":
                made = f"current-{entry['number']:08d}.json"
                state = "LIVE" if store.exists(made) and store.read(made)["ready"] == entry["ready"] else "UNDONE"
                store.write(name, entry | {"state": state}, overwrite=True)
                done.append(f"{entry['run']}: {state}")
    return done


def rollback(spark: SparkSession, root: str) -> str:
    """Point readers to the build before the current one; can be repeated down to the first."""
    store = Store(spark, root)
    number, now = pointer(store)
    if now is None or not now["history"]:
        raise PublishError("there is no build before")
    run = now["history"][-1]
    store.write(f"current-{number + 1:08d}.json", {"run": run, "ready": digest(store.read(f"ready-{run}.json")), "history": now["history"][:-1]})
    return run
