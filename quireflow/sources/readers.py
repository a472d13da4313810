"""Sources: image folders, Markdown folders, mapping files, configuration."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from . import pages

#: Suffixes of images, any case.
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "webp", "bmp", "tif", "tiff")


def is_image_name(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^./]+)\z", 1)).isin(*IMAGE_SUFFIXES)


def list_images(spark: SparkSession, dirs: list[str], limit_per_dir: int | None = None, limit: int | None = None) -> DataFrame:
    """(dir_ord, file_name, path, size) of the images directly in each folder, by folder and name. Contents aren't read.

    ``limit_per_dir`` and ``limit`` are the sampling options of the command line: the first names per folder, then overall.
    """
    found = None
    for i, d in enumerate(dirs):
        one = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(d).select(F.lit(i).alias("dir_ord"), F.regexp_extract("path", r"([^/]*)\z", 1).alias("file_name"), "path", F.col("length").alias("size"))
        found = one if found is None else found.unionByName(one)
    images = found.where(is_image_name(F.col("file_name")))
    return sample(images, limit_per_dir, limit)


def sample(images: DataFrame, limit_per_dir: int | None = None, limit: int | None = None) -> DataFrame:
    out = images
    if limit_per_dir is not None:
        out = out.withColumn("nth", F.row_number().over(Window.partitionBy("dir_ord").orderBy("file_name"))).where(F.col("nth") <= limit_per_dir).drop("nth")
    if limit is not None:
        out = out.orderBy("dir_ord", "file_name").limit(limit)
    return out


def image_size(head: bytes) -> tuple[int, int] | None:
    """(width, height) from the header of a PNG, JPEG, BMP, WebP or TIFF file."""
    if head[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", head[16:24])
    if head[:2] == b"BM":
        w, h = struct.unpack("<ii", head[18:26])
        return w, abs(h)
    if head[:4] == b"RIFF" and head[8:12] == b"WEBP":
        if head[12:16] == b"VP8X":
            return int.from_bytes(head[24:27], "little") + 1, int.from_bytes(head[27:30], "little") + 1
        if head[12:16] == b"VP8L":
            bits = int.from_bytes(head[21:25], "little")
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        w, h = struct.unpack("<HH", head[26:30])
        return w & 0x3FFF, h & 0x3FFF
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(head):
            marker, size = head[at + 1], int.from_bytes(head[at + 2 : at + 4], "big")
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(head[at + 7 : at + 9], "big"), int.from_bytes(head[at + 5 : at + 7], "big")
            at += 2 + size
        return None
    if head[:4] in (b"II*\0", b"MM\0*"):
        order = "little" if head[:2] == b"II" else "big"
        number = lambda a, n: int.from_bytes(head[a : a + n], order)
        at, tags = number(4, 4), {}
        for i in range(number(at, 2)):
            e = at + 2 + 12 * i
            tags[number(e, 2)] = number(e + 8, 2 if number(e + 2, 2) == 3 else 4)
        return (tags[256], tags[257]) if {256, 257} <= tags.keys() else None
    return None


#: Images named one by one to a reader, at most; of more, the folders are read and the names joined.
MOST_PATHS = 10_000
#: Bytes of a file that may hold its size; TIFF directories may stand anywhere.
HEAD_BYTES = 1 << 18


def _same_form(path: Column) -> Column:
    """A path as the file sources write it: the image source puts more slashes before local ones."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _loaded(reader: DataFrameReader, dirs: list[str], chosen: DataFrame | None, path: str = "path") -> DataFrame:
    """What ``reader`` makes of the folders, or of the ``chosen`` paths alone."""
    if chosen is None:
        return reader.load(dirs)
    names = [r.path for r in chosen.select("path").limit(MOST_PATHS + 1).collect()]
    if not names:
        return reader.load(dirs).where(F.lit(False))
    if len(names) <= MOST_PATHS:
        return reader.load(names)
    return reader.load(dirs).join(chosen.select(F.col("path").alias("__chosen")), _same_form(F.col(path)) == _same_form(F.col("__chosen")), "left_semi")


def image_headers(spark: SparkSession, dirs: list[str], chosen: DataFrame | None = None) -> DataFrame:
    """(file_name, path, width, height, image_sha1, banded): sizes from file headers, which alone reach Python; unreadable images have null sizes.

    ``banded`` images are read with ``image_contents``, others with ``image_pixels``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, banded = [], []
            for content in map(bytes, batch["content"]):
                try:
                    sizes.append(image_size(content) or (None, None))
                except (struct.error, IndexError):
                    sizes.append((None, None))
                banded.append(sizes[-1][0] is not None and pages.banded(content, *sizes[-1]))
            yield pd.DataFrame({"path": batch["path"], "width": pd.array([s[0] for s in sizes], "Int32"), "height": pd.array([s[1] for s in sizes], "Int32"), "image_sha1": batch["image_sha1"], "banded": banded})

    tiff = F.hex(F.substring("content", 1, 4)).isin("49492A00", "4D4D002A")
    head = F.when(tiff, F.col("content")).otherwise(F.substring("content", 1, HEAD_BYTES))
    found = _loaded(spark.read.format("binaryFile"), dirs, chosen).where(is_image_name(F.col("path")))
    raw = found.select("path", head.alias("content"), F.sha1("content").alias("image_sha1"))
    sized = raw.mapInPandas(run, "path string, width int, height int, image_sha1 string, banded boolean")
    return sized.withColumn("file_name", F.regexp_extract("path", r"([^/]*)\z", 1))


def image_pixels(spark: SparkSession, dirs: list[str], chosen: DataFrame | None = None) -> DataFrame:
    """Decoded images (of the ``chosen`` paths): path, height, width, nChannels, data (Spark's image source); what can't be decoded is left out."""
    found = _loaded(spark.read.format("image").option("dropInvalid", True), dirs, chosen, "image.origin")
    return found.select(_same_form(F.col("image.origin")).alias("path"), "image.height", "image.width", "image.nChannels", "image.data")


def image_contents(spark: SparkSession, dirs: list[str], chosen: DataFrame | None = None) -> DataFrame:
    """(path, content) of images (of the ``chosen`` paths), for those whose pixels come as bands of rows."""
    found = _loaded(spark.read.format("binaryFile"), dirs, chosen)
    return found.where(is_image_name(F.col("path"))).select(_same_form(F.col("path")).alias("path"), "content")


def read_markdown_dir(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, markdown) of the .md files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("file_name"), F.decode("content", "UTF-8").alias("markdown"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, uuid, afts_id): trimmed rows of the mapping file that have a uuid; a byte-order mark is no part of the header."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    for c in ("uuid", "afts_id"):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    rows = raw.select(F.monotonically_increasing_id().alias("row_no"), *(strip(F.coalesce(c, F.lit(""))).alias(c) for c in ("uuid", "afts_id")))
    return rows.where("uuid <> ''")


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """A published CSV, read as text throughout; empty texts come back empty, and names like NA stay names."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").option("nullValue", "\0").csv(path)


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class RunConfig:
    """What one run reads, writes and is allowed to do."""

    input_dirs: list[str]
    output_csv: str
    work_dir: str
    api_key: str = ""
    user_ids: list[str] = field(default_factory=list)
    api_url: str = ""
    api: dict[str, Any] = field(default_factory=dict)
    chunk: dict[str, Any] = field(default_factory=dict)
    merge: dict[str, Any] = field(default_factory=dict)
    quality: dict[str, Any] = field(default_factory=dict)
    resume: bool = True
    force_api: bool = False
    dry_run: bool = False
    limit: int | None = None
    limit_per_dir: int | None = None

    def snapshot(self) -> dict[str, Any]:
        """Everything but the key."""
        return {**self.__dict__, "api_key": "***"}


def read_yaml(path: str) -> dict[str, Any]:
    import yaml

    if not Path(path).exists():
        raise ConfigError(f"config not found: {path}")
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def read_env(path: str = ".env") -> dict[str, str]:
    """Names and values of a file of NAME=value lines; blank lines and comments are skipped, quotes around a value dropped."""
    if not Path(path).is_file():
        return {}
    pairs = (line.removeprefix("export ").partition("=") for line in map(str.strip, Path(path).read_text(encoding="utf-8").splitlines()) if line[:1] not in ("", "#"))
    return {name.strip(): value.strip().strip("\"'") for name, sign, value in pairs if sign}


def _credentials(env: dict[str, str], prefix: str) -> tuple[str, list[str], str]:
    """Key, users and service address; each has a name with the prefix and an older one."""
    key, users, url = ((env.get(f"{prefix}_{new}") or env.get(old) or "").strip() for new, old in (("API_KEY", "apiKey"), ("USER_IDS", "userIds"), ("API_URL", "apiUrl")))
    return key, [name for name in (part.strip() for part in users.split(",")) if name], url


def load_config(input_dirs: list[str], output_csv: str, work_dir: str, config: str, env: dict[str, str] | None = None, default_url: str = "", env_prefix: str = "OCR", **options: Any) -> RunConfig:
    """Settings from YAML, the environment and a ``.env`` file (the environment goes first). Key and users are needed unless it is a dry run.

    Names in the environment: <prefix>_API_KEY, <prefix>_USER_IDS, <prefix>_API_URL, with apiKey, userIds and
    apiUrl as older names; the URL there goes before that of the file, and a ${...} placeholder means the default.
    """
    sections = read_yaml(config)
    key, users, url = _credentials(read_env() | dict(os.environ) if env is None else env, env_prefix)
    if missing := [d for d in input_dirs if "://" not in d and not Path(d).is_dir()]:
        raise ConfigError(f"no such folder: {', '.join(missing)}")
    if not options.get("dry_run"):
        if absent := [f"{env_prefix}_{name}" for name, value in (("API_KEY", key), ("USER_IDS", users)) if not value]:
            raise ConfigError(f"set {' and '.join(absent)}")
    api = dict(sections.get("api") or {})
    url = url or api.get("url") or default_url
    if url.startswith("${"):
        url = default_url
    users = users or ["dry_run"]
    per_user = int(api.get("per_user_concurrency", 1))
    most = max(1, len(users) * per_user)
    api.update(url=url, per_user_concurrency=per_user, concurrency=min(int(api.get("concurrency", 1)), most))
    return RunConfig(list(input_dirs), output_csv, work_dir, key, users, url, api, *(dict(sections.get(k) or {}) for k in ("chunk", "merge", "quality")), **options)
