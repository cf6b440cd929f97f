"""File sources: folder inventory, validity, name clean-up, routing, archive
names (S1-S4, S15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import text as tx
from quarry.operators.numbering import number_within


def _ext_re(exts) -> str:
    return r"\.(" + "|".join(e.lstrip(".") for e in exts) + r")$"


VALID_RE = _ext_re(config.VALID_EXTS)
IMAGE_RE = _ext_re(config.IMAGE_EXTS)
ARCHIVE_RE = rf"(^|/){config.ARCHIVE_DIR}/"
# splitext: the last dot of the base name that has a non-dot before it
EXT_RE = r"^\.*[^.].*(\.[^.]*)$"


def has_valid_ext(path: Column) -> Column:
    """Lower-cased name ends with an accepted extension."""
    return F.lower(path).rlike(VALID_RE)


def is_image(path: Column) -> Column:
    return F.lower(path).rlike(IMAGE_RE)


def relative_path(path: Column, root: str) -> Column:
    root = root.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def inventory(paths: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """Files below ``root`` with an accepted extension, skipping every
    folder named ``Processado`` below the root (the root itself is kept)."""
    p = F.col(path_col)
    return paths.where(has_valid_ext(p) & ~relative_path(p, root).rlike(ARCHIVE_RE))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """S1 over a real folder: a ``binaryFile`` scan that never reads the
    file contents (only ``path, length, modificationTime`` are selected, so
    the content column is pruned), then the same filters."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
          .select("path", "length", "modificationTime"))
    qualified = df.select(F.regexp_replace("path", r"^file:(//)?", "").alias("path"),
                          "length", "modificationTime")
    return inventory(qualified, root)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def split_ext(name: Column) -> tuple[Column, Column]:
    ext = F.regexp_extract(name, EXT_RE, 1)
    stem = name.substr(F.lit(1), F.length(name) - F.length(ext))
    return stem, ext


def normalize_name(path: Column) -> Column:
    """S3: strip the path, collapse ``//`` and ``/./``, then drop white space
    right before the extension (``"b .docx"`` -> ``"b.docx"``)."""
    p = tx.ustrip(path)
    p = F.regexp_replace(p, r"/(\./)+", "/")
    p = F.regexp_replace(p, r"/{2,}", "/")
    return F.regexp_replace(p, rf"{tx.WS}+(\.[^./]*)$", "$1")


def route(path: Column, strategy: str) -> Column:
    """Images to the image extractor, ``.docx`` to the Word extractor
    whatever the choice, everything else to the chosen strategy."""
    lower = F.lower(path)
    return (F.when(lower.rlike(IMAGE_RE), F.lit("image"))
             .when(lower.endswith(".docx"), F.lit("unstructured"))
             .otherwise(F.lit(strategy)))


def archive_names(df: DataFrame, archive_dir: str, path_col: str = "path",
                  existing: DataFrame | None = None) -> DataFrame:
    """Target path in the archive folder. The first file of a base name, in
    path order, keeps it unless the archive (``existing``: column ``name``) has
    it; the others get the least free ``_1``, ``_2``, ... before the extension.
    A number is free if neither the archive nor any base name here spells it,
    so no two targets are equal. Numbered without sending a whole base-name
    group to one task: the j-th file without a name takes its place in the
    common order of such files and of the taken numbers, each less the number
    of taken ones before it."""
    x = df.withColumn("_base", base_name(F.col(path_col)))
    n = number_within(x, ["_base"], [F.col(path_col)], out="_rn")
    if existing is None:
        old = df.sparkSession.createDataFrame([], "_old string")
    else:
        old = existing.select(F.col("name").alias("_old")).distinct()
    n = n.join(old, F.col("_base") == F.col("_old"), "left")
    j = F.col("_rn") - F.when(F.col("_old").isNull(), 1).otherwise(0)  # 0: keeps its name
    n = n.withColumn("_j", j).drop("_rn", "_old")
    # taken numbers: names that are a stem, an underscore and a number
    stem, ext = split_ext(F.col("_name"))
    names = n.select(F.col("_base").alias("_name")).unionByName(old.withColumnRenamed("_old", "_name"))
    taken = names.distinct().select(F.regexp_extract(stem, r"^(.*)_([1-9][0-9]{0,17})$", 1).alias("_s"),
                                    F.regexp_extract(stem, r"^(.*)_([1-9][0-9]{0,17})$", 2).alias("_k"),
                                    ext.alias("_e")).where("_k <> ''")
    taken = taken.select(F.concat("_s", "_e").alias("_base"), F.col("_k").cast("long").alias("_k"))
    taken = number_within(taken, ["_base"], [F.col("_k")], out="_i")
    order = taken.select("_base", (F.col("_k") - F.col("_i") + 1).alias("_j"), F.lit(0).alias("_new"))
    need = n.where("_j > 0").select("_base", "_j").withColumn("_new", F.lit(1))
    place = number_within(order.unionByName(need), ["_base"], [F.col("_j"), F.col("_new")], out="_k")
    place = place.where("_new = 1").select(F.col("_base").alias("_b"), F.col("_j").alias("_jj"), "_k")
    n = n.join(place, (F.col("_base") == F.col("_b")) & (F.col("_j") == F.col("_jj")), "left")
    stem, ext = split_ext(F.col("_base"))
    name = F.when(F.col("_j") == 0, F.col("_base")).otherwise(
        F.concat(stem, F.lit("_"), F.col("_k").cast("string"), ext))
    return n.withColumn("target", F.concat(F.lit(archive_dir.rstrip("/") + "/"), name)) \
            .drop("_base", "_j", "_b", "_jj", "_k")


def file_documents(files: DataFrame, root: str, decode, done: DataFrame | None = None) -> DataFrame:
    """F3's front over ``binaryFile`` rows (``path, content``): S1 (accepted
    types, the archive subtree skipped), S3 (the cleaned path is the
    document key ``parent``), inputs already handled (``done``, a ``parent``
    column) left out before any decoding, then S7 through the user's
    ``decode(bytes, path) -> text`` hook, once per file inside the task; a
    failing file has no text, so the gate marks it ``error``. ``name`` is the
    original base name, M1's ``__parent``."""
    from quarry.plans.ingest import new_inputs
    from quarry.sources.html import binary_extractor
    q = files.select(F.regexp_replace("path", r"^file:(//)?", "").alias("path"), "content")
    rows = inventory(q, root).withColumn("parent", normalize_name(F.col("path")))
    if done is not None:
        rows = new_inputs(rows, done)
    text = binary_extractor(rows, decode)
    return text.select(normalize_name(F.col("path")).alias("parent"), "text",
                       base_name(F.col("path")).alias("name"))

