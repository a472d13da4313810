"""The restoration run: images -> chunks -> texts -> merged files -> gate, reruns -> summary -> CSV.

One declarative plan per pass over the files; the only shuffles by file are those of reading order
and merging, which share their key.  Every materialised step is a table in the work folder, so a lost executor or a
stopped run costs one step; texts that were recognised and validated once aren't asked for again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize
from ..operators import cache, chunking, gate, layout, merge, ordering, profile, recognize, retry, tables
from ..sources import readers, sinks


class RunError(RuntimeError):
    pass


Service = Callable[[dict, str], tuple[int, str]]


def texts_to_files(chunk_texts: DataFrame, mode: str = "fixed", merge_options: dict[str, Any] | None = None) -> DataFrame:
    """(file_name, markdown, removed, repaired_tags, chunk_count, failed_chunks) of recognised chunks with their boxes."""
    normal = chunk_texts.withColumn("markdown", normalize(F.col("markdown"), mode))
    counts = chunk_texts.groupBy("file_name").agg(F.count(F.lit(1)).cast("int").alias("chunk_count"), F.count_if(~F.col("ok")).cast("int").alias("failed_chunks"))
    ordered = merge.may_overlap(ordering.mark_toc(ordering.reading_order(normal)))
    merged = tables.repair(merge.merge(ordered, **(merge_options or {})))
    # a file whose cells are all reference cells has counts but no text
    return counts.join(merged, "file_name", "left").withColumn("markdown", F.coalesce("markdown", F.lit("")))


class Run:
    """One run over a set of images, with its work folder."""

    def __init__(self, spark: SparkSession, config: readers.RunConfig, service: Service | None = None, mode: str = "fixed", sleep: Callable[[float], None] | None = None):
        self.spark, self.config, self.service, self.mode, self.sleep = spark, config, service, mode, sleep
        self.id = uuid.uuid4().hex[:12]

    def _path(self, name: str) -> str:
        return f"{self.config.work_dir.rstrip('/')}/{name}"

    def _hold(self, df: DataFrame, name: str) -> DataFrame:
        path = self._path(f"steps/{self.id}/{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _cached(self) -> DataFrame:
        path = self._path("api_cache")
        return self.spark.read.schema(cache.SCHEMA).parquet(path) if sinks.exists(self.spark, path) else self.spark.createDataFrame([], cache.SCHEMA)

    def images(self) -> DataFrame:
        """Profiled images of the input folders, sampled as asked; a repeated name stops the run."""
        c = self.config
        listed = readers.list_images(self.spark, c.input_dirs)
        report = gate.check_inputs(listed).first()
        if not report.passed:
            raise RunError(",".join(report.risks))
        chosen = readers.sample(listed, c.limit_per_dir, c.limit)
        return profile.profile(chosen.join(readers.image_headers(self.spark, c.input_dirs, chosen), ["file_name", "path"]))

    def _sources(self, images: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Decoded pages and, of those that are large or WebP, the files."""
        dirs = self.config.input_dirs
        return readers.image_pixels(self.spark, dirs, images.where("not banded")), readers.image_contents(self.spark, dirs, images.where("banded"))

    def chunks(self, images: DataFrame) -> DataFrame:
        """Chunks with ids and ordinals; strips snap to the blank bands of their pages. Unreadable images have none."""
        strips = images.where("doc_type = 'long_strip'")
        bands = layout.analyze(*self._sources(strips))
        with_bands = images.where("width is not null").join(bands.select("path", F.col("horizontal_blank_bands").alias("bands")), "path", "left")
        o = self.config.chunk
        cut = chunking.chunk(
            with_bands.withColumn("bands", F.coalesce("bands", F.array().cast("array<struct<s:int,e:int>>"))), "bands", int(o.get("long_window_height", chunking.WINDOW)), int(o.get("long_vertical_overlap", chunking.OVERLAP)),
            chunk_pixels=int(o.get("max_chunk_pixels", chunking.CHUNK_PIXELS)), page_pixels=int(o.get("table_full_page_max_pixels", chunking.PAGE_PIXELS)),
            overlap_x=int(o.get("table_horizontal_overlap", chunking.GRID_X)), overlap_y=int(o.get("table_vertical_overlap", chunking.GRID_Y)),
        )
        # ordinals only have to be distinct and to follow rows within a file
        cut = self._hold(cut.drop("bands").withColumn("ordinal", F.monotonically_increasing_id()), "chunks")
        sinks.write_lines(chunking.manifest(cut), "manifest", self._path("manifests"))
        return cut

    def crops(self, chunks: DataFrame) -> DataFrame:
        """``chunks`` with their pixels as PNG files (``crop``), null where an image can't be decoded."""
        pixels, files = self._sources(chunks.select("path", "banded").distinct())
        return chunks.join(layout.crops(pixels, chunks.select("path", "chunk_id", "x0", "y0", "x1", "y1"), files), "chunk_id", "left")

    def recognised(self, chunks: DataFrame, force: bool, concurrency: int | None) -> DataFrame:
        c = self.config
        known = cache.hits(chunks, self._cached(), c.api_url) if not force else cache.hits(chunks, self._cached().limit(0), c.api_url)
        known = known.withColumn("ok", F.lit(True)).withColumn("block_type", F.when(F.contains(F.lower("markdown"), F.lit("<table")), "table").otherwise("body"))
        todo = cache.misses(chunks, known)
        if self.service is None:
            raise RunError("no recognition service")
        extra = {"sleep": self.sleep} if self.sleep else {}
        new = recognize.recognize(self._hold(self.crops(todo), "crops"), self.service, c.user_ids, concurrency or int(c.api.get("concurrency", 1)), int(c.api.get("per_user_concurrency", 1)), int(c.api.get("max_retries", recognize.MAX_RETRIES)), hold=self._hold, **extra)
        new = self._hold(new.drop("crop"), "recognised")
        sinks.append_table(cache.entries(new, c.api_url), self._path("api_cache"))
        log = new.select(F.lit("api_call").alias("event"), F.lit(self.id).alias("run_id"), "file_name", "chunk_id", F.explode("log").alias("call"), cache.text_sha1().alias("response_sha1"), F.col("ok").alias("content_validated"))
        hit = known.select(F.lit("api_call").alias("event"), F.lit(self.id).alias("run_id"), "file_name", "chunk_id", F.lit("").alias("user_id"), F.lit("cache").alias("status"), F.lit(0).alias("retry_index"), F.lit(0).cast("long").alias("elapsed_ms"), F.length("markdown").cast("long").alias("response_chars"), cache.text_sha1().alias("response_sha1"), F.lit(True).alias("content_validated"))
        sinks.append_json(log.select("event", "run_id", "file_name", "chunk_id", "call.*", "response_sha1", "content_validated").unionByName(hit), self._path("logs"))
        cols = [*chunks.columns, "ok", "markdown", "block_type", "source"]
        texts = known.select(cols).unionByName(new.select(cols))
        sinks.write_json(texts.select("file_name", "chunk_id", normalize(F.col("markdown"), self.mode).alias("markdown")), self._path(f"chunk_texts/{uuid.uuid4().hex[:8]}"))
        return texts

    def checked(self, images: DataFrame, files: DataFrame) -> DataFrame:
        q = self.config.quality
        rows = images.select("file_name", "doc_type").join(files, "file_name", "left")
        rows = rows.withColumn("markdown", F.coalesce("markdown", F.lit(""))).withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0))).withColumn("failed_chunks", F.coalesce("failed_chunks", F.lit(0)))
        return gate.check_files(rows, float(q.get("max_duplication_ratio", gate.MAX_DUPLICATION)), float(q.get("max_api_failure_ratio", gate.MAX_FAILURE)))

    def _pass(self, images: DataFrame, chunks: DataFrame, force: bool, concurrency: int | None) -> DataFrame:
        m = self.config.merge
        options = {"window": int(m.get("dedup_window_chars_long", merge.WINDOW_BODY)), "window_table": int(m.get("dedup_window_chars_table", merge.WINDOW_TABLE)), "likeness": float(m.get("dedup_similarity_threshold", merge.LIKENESS))}
        files = texts_to_files(self.recognised(chunks, force, concurrency), self.mode, options)
        return self.checked(images, files).select("file_name", "doc_type", "markdown", "chunk_count", "failed_chunks", "chars", "duplication_ratio", "api_failure_ratio", "risks", "passed")

    def _summary_document(self, files: DataFrame, head: dict[str, Any]) -> None:
        """The run as one JSON file, ``summary.json``: totals, failed names, and each file with its quality."""
        name = F.to_json(F.struct(F.col("file_name").alias("v")))
        metrics = F.struct("chars", "duplication_ratio", "chunk_count", "failed_chunks", "api_failure_ratio", "doc_type", "from_merged_cache")
        told = F.to_json(F.struct("file_name", "rerun_count", F.struct("passed", "risks", metrics.alias("metrics")).alias("quality")), {"ignoreNullFields": "false"})
        lists = {"failed_files": (files.where("not passed"), "file_name", F.substring(name, F.lit(6), F.length(name) - 6)), "files": (files, "file_name", told)}
        sinks.write_document(head, lists, self._path("summary.json"))

    def run(self) -> DataFrame:
        """Checked files (rerun_count, from_merged_cache). Publishes the CSV unless a file failed or it is a dry run."""
        c = self.config
        images = self._hold(self.images(), "images")
        sinks.write_lines(self.spark.createDataFrame([(json.dumps(c.snapshot(), ensure_ascii=False, default=str),)], "config string"), "config", self._path("config"))
        sinks.write_json(images, self._path("profiles"))
        if c.dry_run:
            per_file = self.chunks(images).groupBy("file_name").agg(F.count(F.lit(1)).alias("chunks"))
            # a dry run leaves no texts that a later run could take for results
            report = images.select("file_name", "doc_type").join(per_file, "file_name", "left").withColumns({"passed": F.lit(True), "dry_run": F.lit(True)})
            sinks.write_json(report, self._path("qc"))
            return report
        sinks.delete(self.spark, c.output_csv)
        merged = self._path("merged")
        done_before = self.spark.read.parquet(merged).groupBy("file_name").agg(F.max_by("markdown", "written").alias("markdown")) if sinks.exists(self.spark, merged) else None
        todo, ready = cache.work_list(images, done_before, c.resume, c.force_api)
        todo = self._hold(todo, "todo")
        limit = int(c.quality.get("max_reruns_per_file", retry.MAX_RERUNS))
        chunks = self.chunks(todo)

        def again(planned: DataFrame) -> DataFrame:
            # force and concurrency are plans per file; files with equal plans run together
            out = None
            for force in (False, True):
                for one in (0, 1):
                    part = planned.where((F.col("force_api") == force) & (F.col("concurrency") == one)).select("file_name", "doc_type")
                    if part.isEmpty():
                        continue
                    got = self._pass(part, chunks.join(part.select("file_name"), "file_name", "left_semi"), force, one or None)
                    out = got if out is None else out.unionByName(got)
            return out

        first = self._pass(todo, chunks, c.force_api, None).withColumn("rerun_count", F.lit(0))
        files = retry.rerun_until(first, again, limit, self._hold).withColumn("from_merged_cache", F.lit(0))
        if ready is not None:
            held = self.checked(images, ready.select("file_name", "markdown", F.lit(0).alias("chunk_count"), F.lit(0).alias("failed_chunks"))).join(ready.select("file_name"), "file_name", "left_semi")
            files = files.unionByName(held.withColumn("rerun_count", F.lit(0)).withColumn("from_merged_cache", F.lit(1)), allowMissingColumns=True)
        files = self._hold(files, "files")
        sinks.append_table(files.where("from_merged_cache = 0").select("file_name", "markdown", F.current_timestamp().alias("written")), merged)
        sinks.write_json(files.drop("markdown"), self._path("qc"))
        # a run's names and risks as tables of their own, and the few risks once more by count
        sinks.write_json(gate.failed_files(files), self._path("failed_files"))
        counts = gate.risk_counts(files)
        sinks.write_json(counts, self._path("risk_counts"))
        risks = counts.agg(F.map_from_entries(F.collect_list(F.struct("risk", "n"))).alias("risk_counts"))
        summary = self._hold(gate.run_summary(files).crossJoin(risks), "summary")  # two rows of one
        sinks.write_json(summary.withColumn("output_csv", F.lit(c.output_csv)).withColumn("dry_run", F.lit(False)), self._path("summary"))
        row = summary.first()
        self._summary_document(files, {**row.asDict(), "risk_counts": row.risk_counts or {}, "output_csv": c.output_csv, "dry_run": False})
        if not row.passed:
            raise RunError("quality gate failed")
        sinks.publish(files.select("file_name", F.col("markdown").alias("ground_truth")), c.output_csv, images.select("file_name"))
        return files
