"""Annotation import: scaling, media lookup, matching of existing buttons, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditflow.functions.text import trim_blanks
from auditflow.operators import ranges
from auditflow.operators.checks import explode_rules
from auditflow.operators.matching import relative_path
from auditflow.sources.scans import MEDIA_LIMIT

# Fixed value: width of the canvas in pixels.
CANVAS_WIDTH = 794.0
# Component ids of the audio and the transcript button.
COMPONENTS = {"audio": 265, "transcript": 506}
POSITION_TOLERANCE = 0.5


def unique_pages(pages: DataFrame) -> DataFrame:
    """One usable descriptor per file and page number; the last one of the file's list counts."""
    usable = pages.where("page > 0 AND width > 0 AND height > 0")
    return ranges.pick_last(usable, ["path", "page"], [F.col("pos")], ["width", "height"])


def scale_annotations(ann: DataFrame, pages: DataFrame, canvas_width: float = CANVAS_WIDTH) -> DataFrame:
    """Annotation boxes in canvas pixels; rows without a page in their own file keep nulls.

    The page side is unique per key, so a page with very many annotations is a
    skewed probe side that adaptive execution can split.
    """
    sides = unique_pages(pages).select(
        F.col("path").alias("_path"), F.col("page").alias("_page"), F.col("width").alias("page_width"), F.col("height").alias("page_height"))
    joined = ann.join(sides, (F.col("path") == F.col("_path")) & (F.col("page") == F.col("_page")), "left").drop("_path", "_page")
    scale = F.lit(float(canvas_width)) / F.col("page_width")
    out = joined.withColumn("scale", scale)
    return out.withColumns({
        "left_px": F.col("x") * F.col("scale"), "top_px": F.col("y") * F.col("scale"),
        "width_px": F.col("width") * F.col("scale"), "height_px": F.col("height") * F.col("scale"),
    })


def placed(scaled: DataFrame) -> DataFrame:
    """Rows that have a page and all four numbers; only these enter the plan."""
    return scaled.where("scale IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND width IS NOT NULL AND height IS NOT NULL")


def out_of_bounds(scaled: DataFrame) -> Column:
    beyond = (F.col("x") + F.col("width") > F.col("page_width")) | (F.col("y") + F.col("height") > F.col("page_height"))
    return F.coalesce(beyond, F.lit(False))


def resolve_media(ann: DataFrame, files: DataFrame, limit: int = MEDIA_LIMIT, relative: bool = False) -> DataFrame:
    """Size and ``media_status`` of audio files: ok, missing, too_large or ambiguous.

    Files are found by base name in the inventory, where equal names in several folders
    are ambiguous, or with ``relative`` by their path as seen from the annotation file.
    """
    plain = F.array_join(F.filter(F.split("path", "/"), lambda s: ~s.isin("", ".")), "/")
    sizes = files.groupBy((plain if relative else F.col("basename")).alias("_base")).agg(F.max("length").alias("audio_size"), F.count_distinct("path").alias("_places"))
    folder = F.regexp_replace("path", r"[^/\\]*$", "")
    wanted = relative_path(folder, F.col("audio_path")) if relative else F.regexp_extract("audio_path", r"[^/\\]+$", 0)
    joined = ann.withColumn("_b", F.when(F.col("type") == "audio", wanted)).join(sizes, F.col("_b") == F.col("_base"), "left")
    status = (
        F.when(F.col("type") != "audio", None)
        .when(F.col("audio_size").isNull(), "missing")
        .when(F.col("_places") > 1, "ambiguous")
        .when(F.col("audio_size") > limit, "too_large").otherwise("ok")
    )
    return joined.withColumn("media_status", status).drop("_b", "_base", "_places")


def judged_annotations(ann: DataFrame, pages: DataFrame, files: DataFrame, relative: bool = False) -> DataFrame:
    """Scaled annotations with their media and the first place of their id in the file."""
    rows = resolve_media(scale_annotations(ann, pages), files, relative=relative)
    return rows.withColumn("first_pos", F.min("pos").over(Window.partitionBy("path", "id")))


def annotation_violations(rows: DataFrame) -> DataFrame:
    """Violations of judged annotations; entities are named ``file#id``."""
    geometry_ok = (F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("width") > 0) & (F.col("height") > 0)
    transcript = F.col("type") == "transcript"
    blank = lambda c: trim_blanks(F.coalesce(F.col(c), F.lit(""))) == ""
    own = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.concat(F.lit("annotations["), F.col("pos").cast("string"), F.lit("]")))
    return explode_rules(rows.withColumn("entity_id", F.concat("path", F.lit("#"), own)), [
        ("id_missing", "error", blank("id")),
        ("id_duplicate", "error", ~blank("id") & (F.col("pos") > F.col("first_pos"))),
        ("type_invalid", "error", ~F.coalesce(F.col("type").isin(list(COMPONENTS)), F.lit(False))),
        ("page_missing", "error", F.col("scale").isNull()),
        ("geometry_invalid", "error", ~F.coalesce(geometry_ok, F.lit(False))),
        ("box_out_of_bounds", "warning", out_of_bounds(rows)),
        ("audio_path_missing", "error", (F.col("type") == "audio") & blank("audio_path")),
        ("audio_file_missing", "error", ~blank("audio_path") & (F.col("media_status") == "missing")),
        ("audio_file_ambiguous", "error", F.col("media_status") == "ambiguous"),
        ("audio_file_too_large", "error", F.col("media_status") == "too_large"),
        ("question_missing", "error", transcript & blank("question")),
        ("text_missing", "error", transcript & blank("text")),
    ])


def page_violations(pages: DataFrame) -> DataFrame:
    """Violations of page descriptors; entities are named ``file#page n``."""
    bad_page = ~F.coalesce((F.col("page") > 0) & (F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    page_rows = pages.groupBy("path", "page").agg(
        F.count("*").alias("n"), F.max(bad_page.cast("int")).alias("bad")
    ).withColumn("entity_id", F.concat("path", F.lit("#page "), F.coalesce(F.col("page").cast("string"), F.lit("?"))))
    return explode_rules(page_rows, [
        ("page_descriptor_invalid", "error", F.col("bad") == 1),
        ("page_descriptor_duplicate", "error", F.col("n") > 1),
    ])


def validate_annotations(ann: DataFrame, pages: DataFrame, files: DataFrame, relative: bool = False) -> DataFrame:
    """Violations of annotations and of page descriptors, file by file."""
    return annotation_violations(judged_annotations(ann, pages, files, relative)).unionByName(page_violations(pages))


def match_existing(planned: DataFrame, existing: DataFrame, tol: float = POSITION_TOLERANCE) -> DataFrame:
    """State of each planned button: done, partial (button without module) or pending.

    Both sides have page, component, left_px and top_px; existing also has
    has_module.  Positions fall into cells of side ``tol``.  A point in the same
    cell always matches; the eight cells around are judged by the extremes of
    each cell, and a diagonal cell with several points by a running minimum, so
    no pairs are built however many points share a place.
    """
    keys = ["page", "component"]

    def celled(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "_gx": F.floor(F.col("left_px") / tol).cast("bigint"), "_gy": F.floor(F.col("top_px") / tol).cast("bigint")})

    points = celled(existing.groupBy(*keys, "left_px", "top_px").agg(F.max("has_module").alias("has_module")))

    def extremes(flag: str, when: Column) -> list[Column]:
        x, y = F.when(when, F.col("left_px")), F.when(when, F.col("top_px"))
        return [F.count(x).alias(f"n_{flag}"), F.min(x).alias(f"x0_{flag}"), F.max(x).alias(f"x1_{flag}"),
                F.min(y).alias(f"y0_{flag}"), F.max(y).alias(f"y1_{flag}")]

    cells = points.groupBy(*keys, "_gx", "_gy").agg(
        *extremes("any", F.lit(True)), *extremes("mod", F.col("has_module")))
    around = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                                 for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    # Many planned copies of one place are judged once.
    places = celled(planned.select(*keys, "left_px", "top_px").distinct())
    probe = places.select("*", around.alias("_d")).select(
        *keys, "left_px", "top_px", F.col("_d.dx").alias("dx"), F.col("_d.dy").alias("dy"),
        (F.col("_gx") + F.col("_d.dx")).alias("_gx"), (F.col("_gy") + F.col("_d.dy")).alias("_gy"))
    near = probe.join(cells, [*keys, "_gx", "_gy"])

    def close(flag: str) -> Column:
        x = F.when(F.col("dx") == 1, F.col(f"x0_{flag}") - F.col("left_px")).when(
            F.col("dx") == -1, F.col("left_px") - F.col(f"x1_{flag}")).otherwise(0.0)
        y = F.when(F.col("dy") == 1, F.col(f"y0_{flag}") - F.col("top_px")).when(
            F.col("dy") == -1, F.col("top_px") - F.col(f"y1_{flag}")).otherwise(0.0)
        return (F.col(f"n_{flag}") > 0) & (x <= tol) & (y <= tol)

    diagonal = (F.col("dx") != 0) & (F.col("dy") != 0)
    judged = near.withColumns({
        f: F.when(~close(f), F.lit(False)).when(~diagonal | (F.col(f"n_{f}") == 1), F.lit(True)) for f in ("any", "mod")})
    open_cells = judged.where(F.col("any").isNull() | F.col("mod").isNull())
    asks = open_cells.select(
        *keys, "_gx", "_gy", "dx", "dy", (F.col("dx") * F.col("left_px") + tol).alias("ord"), F.lit(1).alias("is_ask"),
        F.lit(None).cast("double").alias("v"), F.lit(False).alias("has_module"), "left_px", "top_px")
    asked = open_cells.select(*keys, "_gx", "_gy", "dx", "dy").distinct()
    offers = points.join(asked, [*keys, "_gx", "_gy"]).select(
        *keys, "_gx", "_gy", "dx", "dy", (F.col("dx") * F.col("left_px")).alias("ord"), F.lit(0).alias("is_ask"),
        (F.col("dy") * F.col("top_px")).alias("v"), "has_module", "left_px", "top_px")
    swept = ranges.running(
        offers.unionByName(asks), [*keys, "_gx", "_gy", "dx", "dy"], ["ord", "is_ask", "left_px", "top_px"],
        {"least": ("min", F.col("v")), "least_mod": ("min", F.when(F.col("has_module"), F.col("v")))})
    bound = F.col("dy") * F.col("top_px") + tol
    swept_verdict = swept.where("is_ask = 1").select(
        *keys, "left_px", "top_px", (F.col("least") <= bound).alias("any"), (F.col("least_mod") <= bound).alias("mod"))
    verdict = judged.select(*keys, "left_px", "top_px", "any", "mod").unionByName(swept_verdict)
    best = verdict.groupBy(*keys, "left_px", "top_px").agg(F.max("any").alias("_any"), F.max("mod").alias("_mod"))
    status = F.when(F.col("_mod"), "done").when(F.col("_any"), "partial").otherwise("pending")
    return planned.join(best, [*keys, "left_px", "top_px"], "left").withColumn("status", status).drop("_any", "_mod")
