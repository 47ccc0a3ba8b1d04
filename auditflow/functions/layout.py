"""Size rules of the phone layout as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Width of the word card row, gap and least font size, in pixels.
WORD_ROW_WIDTH, WORD_GAP, LEAST_FONT = 262, 6, 10
# Tail spacer.
SPACER_WIDTH, SPACER_HEIGHT, SPACER_TYPE, SPACER_COLOR = 375, 20, "phone", "#CECECE"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def js_length(text: Column | str) -> Column:
    """Length in UTF-16 code units."""
    return (F.octet_length(F.encode(_col(text), "UTF-16BE")) / 2).cast("int")


def title_size(title: Column | str) -> Column:
    n = js_length(title)
    return F.struct(
        F.when(n <= 24, 18).otherwise(16).alias("font_px"),
        F.when(n >= 30, 2).otherwise(1).alias("lines"),
        F.when(n >= 30, 48).alias("height_px"),
        F.when(n >= 30, 24).otherwise(0).alias("shift_px"),
    )


def sentence_box(sentences: Column | str) -> Column:
    s = _col(sentences)
    n = F.size(s)
    longest = F.coalesce(F.array_max(F.transform(s, js_length)), F.lit(0))
    many = n >= 4
    font = (
        F.when(longest > 55, 11).when(longest >= 50, 12)
        .when(many | (longest >= 45), 13).otherwise(16)
    )
    fits = n.between(2, 5)
    return F.struct(
        F.when(n.isin(2, 3), 72).when(n == 4, 96).when(n == 5, 120).alias("box_h"),
        F.when(n.isin(2, 3), 588).when(n == 4, 612).when(n == 5, 636).alias("block_h"),
        F.when(fits, font).alias("font_px"),
    )


def word_columns(english: Column | str, chinese: Column | str, base_font: int = 14) -> Column:
    """Widths of the columns english, chinese, english, chinese over two rows of two pairs."""
    en, zh = _col(english), _col(chinese)

    def width(words: Column, first: int, per: int, extra: int) -> Column:
        lengths = [js_length(F.coalesce(F.get(words, F.lit(i)), F.lit(""))) for i in (first, first + 2)]
        return F.greatest(*lengths) * per + extra

    widths = F.array(width(en, 0, 9, 6), width(zh, 0, 16, 4), width(en, 1, 9, 6), width(zh, 1, 16, 4))
    total = F.aggregate(widths, F.lit(0), lambda a, w: a + w) + 3 * WORD_GAP
    scale = F.least(F.lit(1.0), F.lit(float(WORD_ROW_WIDTH)) / total)
    return F.struct(
        widths.alias("widths"), total.alias("total_px"), F.round(scale, 6).alias("scale"),
        F.greatest(F.lit(LEAST_FONT), F.floor(scale * base_font)).cast("int").alias("font_px"),
    )


def spacer_ok(width: Column, height: Column, kind: Column, color: Column, n_elements: Column) -> Column:
    good = (
        (width == SPACER_WIDTH) & (height == SPACER_HEIGHT) & (kind == SPACER_TYPE)
        & (F.upper(color) == SPACER_COLOR) & (n_elements == 0)
    )
    return F.coalesce(good, F.lit(False))


def iso_utc(text: Column | str) -> Column:
    """The instant of ``YYYY-MM-DDTHH:MM:SS[.mmm]Z``, else null."""
    c = _col(text)
    return F.when(
        c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?Z$"), c.try_cast("timestamp")
    )


def card_plan(n_titles: Column | str) -> Column:
    n = _col(n_titles)
    return (
        F.when(n == 0, "drop_section").when(n == 1, "drop_second_card").when(n == 2, "keep")
        .when(n.between(3, 4), "clone_cards").otherwise("stop")
    )


def layout_plan(pages: DataFrame, title: str, sentences: str, english: str, chinese: str) -> DataFrame:
    """All size decisions per page."""
    return (
        pages.withColumn("_t", title_size(title))
        .withColumn("_s", sentence_box(sentences))
        .withColumn("_w", word_columns(english, chinese))
        .select(
            "page_id", F.col("_t.font_px").alias("title_px"), F.col("_t.lines").alias("title_lines"),
            F.col("_t.shift_px").alias("shift_px"), F.col("_s.box_h").alias("box_h"),
            F.col("_s.block_h").alias("block_h"), F.col("_s.font_px").alias("sentence_px"),
            F.array_join(F.col("_w.widths").cast("array<string>"), ",").alias("columns"),
            F.col("_w.total_px").alias("total_px"), F.col("_w.font_px").alias("word_px"),
        )
    )
