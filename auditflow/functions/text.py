"""Text, markup and number normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Volume synonyms, upper volume and lower volume.
UPPER_VOLUME = ["上", "上册", "第一册", "1"]
LOWER_VOLUME = ["下", "下册", "第二册", "2"]
# Module types of the two annotation buttons.
AUDIO_MODULE, TRANSCRIPT_MODULE = 77, 76
# What the names of the two buttons begin with.
AUDIO_NAME, TRANSCRIPT_NAME = "播放 ", "查看听力原文："
# The characters that JavaScript takes for blanks in patterns and when trimming.
BLANK = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# Emphasis red in its two spellings.
EMPHASIS_COLORS = ["#fe2e65", "rgb(254, 46, 101)"]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_blanks(value: Column | str) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(_col(value), f"^{BLANK}+|{BLANK}+$", "")


def _where_has(html: Column, signs: tuple[str, ...], made: Callable[[set[str]], Column]) -> Column:
    """``made`` of those signs that occur in a text, so that no pattern is tried on a text it cannot match."""
    def branch(left: tuple[str, ...], seen: set[str]) -> Column:
        if not left:
            return made(seen)
        return F.when(F.contains(html, F.lit(left[0])), branch(left[1:], seen | {left[0]})).otherwise(branch(left[1:], seen))

    return branch(signs, set())


def html_lines(html: Column | str, angle_entities: bool = True) -> Column:
    """Visible lines of rich text, blank lines dropped.

    ``&amp;`` is decoded before ``&lt;``, so a doubly escaped sign opens fully.
    """
    raw = F.coalesce(_col(html), F.lit(""))

    def plain(signs: set[str]) -> Column:
        c = raw
        if "<" in signs:
            for pattern in (rf"(?i)<br{BLANK}*/?>", rf"(?i)</p>{BLANK}*<p[^>]*>", rf"(?i)</li>{BLANK}*<li[^>]*>"):
                c = F.regexp_replace(c, pattern, "\n")
            c = F.regexp_replace(c, r"(?i)</?(?:ol|ul)[^>]*>", "")
            c = F.regexp_replace(c, r"<[^>]+>", "")
        if "&" in signs:
            c = F.regexp_replace(c, r"&#39;|&apos;", "'")
            entities = [("&quot;", '"'), ("&amp;", "&")]
            if angle_entities:
                entities += [("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")]
            for name, sign in entities:
                c = F.replace(c, F.lit(name), F.lit(sign))
        return c

    # blanks of any kind are spaces before the ends are trimmed
    lines = F.transform(F.split(_where_has(raw, ("<", "&"), plain), r"\r?\n"), lambda s: F.trim(F.regexp_replace(s, f"{BLANK}+", " ")))
    return F.filter(lines, lambda s: s != "")


def html_text(html: Column | str) -> Column:
    """Visible text of a page on one line, spacing before punctuation removed."""
    raw = F.coalesce(_col(html), F.lit(""))

    def plain(signs: set[str]) -> Column:
        c = raw
        if "<" in signs:
            c = F.regexp_replace(c, rf"(?i)<br{BLANK}*/?>", " ")
            c = F.regexp_replace(c, rf"(?i)</(?:p|div|li|h[1-6]){BLANK}*>", " ")
            c = F.regexp_replace(c, r"<[^>]+>", "")
        if "&" in signs:
            for name, sign in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')):
                c = F.regexp_replace(c, f"(?i){name}", sign)
            c = F.regexp_replace(c, r"(?i)&#39;|&apos;", "'")
        return c

    c = F.regexp_replace(_where_has(raw, ("<", "&"), plain), f"{BLANK}+", " ")
    # blanks of any kind are spaces before the ends are trimmed
    return F.trim(F.regexp_replace(c, " ([.,!?;:])", "$1"))


def kept_style(style: Column) -> Column:
    """Only the color declarations of a style attribute."""
    parts = F.transform(F.split(style, ";"), trim_blanks)
    return F.array_join(F.filter(parts, lambda s: s.rlike(rf"(?i)^(background-color|color){BLANK}*:")), "; ")


def restyled(html: Column | str) -> Column:
    """Bold tags become spans and styles keep their color declarations only."""
    tokens = F.regexp_extract_all(F.coalesce(_col(html), F.lit("")), F.lit(r"(<[^>]*>|[^<]+|<)"), F.lit(1))
    bold = r"(?i)^<b\b[^>]*>$"
    styled_span = r'(?i)^<span\b([^>]*)style="([^"]*)"([^>]*)>$'

    def one(token: Column) -> Column:
        bold_kept = kept_style(F.regexp_extract(token, r'(?i)^<b\b[^>]*style="([^"]*)"[^>]*>$', 1))
        as_span = F.when(bold_kept != "", F.concat(F.lit('<span style="'), bold_kept, F.lit(';">'))).otherwise("<span>")
        kept = kept_style(F.regexp_extract(token, styled_span, 2))
        before, after = (F.regexp_extract(token, styled_span, i) for i in (1, 3))
        span = F.concat(
            F.lit("<span"), before,
            F.when(kept != "", F.concat(F.lit('style="'), kept, F.lit(';"'))).otherwise(""),
            after, F.lit(">"),
        )
        return (
            F.when(token.rlike(bold), as_span)
            .when(F.lower(token) == "</b>", F.lit("</span>"))
            .when(token.rlike(styled_span), span)
            .otherwise(token)
        )

    return F.array_join(F.transform(tokens, one), "")


def escaped(text: Column | str) -> Column:
    c = _col(text)
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def transcript_html(question: Column | str, text: Column | str) -> Column:
    body = F.regexp_replace(escaped(text), r"\r?\n", "<br>")
    return F.concat(F.lit("<strong>"), escaped(question), F.lit("</strong>"), body)


def annotation_payload(kind: Column | str, title: Column | str, text: Column | str) -> Column:
    """Module type, name and configuration of the button for an audio or a transcript annotation."""
    audio = _col(kind) == "audio"
    return F.struct(
        F.when(audio, AUDIO_MODULE).when(_col(kind) == "transcript", TRANSCRIPT_MODULE).alias("module_type"),
        F.concat(F.when(audio, AUDIO_NAME).otherwise(TRANSCRIPT_NAME), _col(title)).alias("name"),
        F.when(~audio, transcript_html(title, text)).alias("config"))


def normalize_name(c: Column | str) -> Column:
    return trim_blanks(F.regexp_replace(_col(c), f"{BLANK}+", " "))


def compact_text(c: Column | str) -> Column:
    return F.nullif(F.regexp_replace(F.lower(_col(c)), f"{BLANK}+", ""), F.lit(""))


def normalize_volume(c: Column | str) -> Column:
    v = compact_text(c)
    return F.when(v.isin(UPPER_VOLUME), "上册").when(v.isin(LOWER_VOLUME), "下册").otherwise(v)


def normalize_path(c: Column | str) -> Column:
    parts = F.transform(F.split(_col(c), r"[/>\\]"), compact_text)
    return F.nullif(F.array_join(F.filter(parts, lambda p: p.isNotNull()), "/"), F.lit(""))


def _digits_value(digits: Column, bits: int) -> Column:
    """The double nearest to digits of ``bits`` bits each, however many there are.

    Sixty leading bits are read, and the lowest of them is set if anything nonzero follows.
    """
    held = 60 // bits
    plain = F.regexp_replace(digits, "^0+(?=.)", "")
    head = F.conv(F.substring(plain, 1, held), 2**bits, 10).cast("bigint")
    rest = F.substring(plain, F.lit(held + 1), F.length(plain))
    marked = F.when(rest.rlike("[^0]"), head.bitwiseOR(F.lit(1))).otherwise(head)
    return marked.cast("double") * F.pow(F.lit(2.0), F.length(rest) * bits)


def finite_number(c: Column | str) -> Column:
    """A finite number written as decimal, exponent, hex, octal or binary text."""
    s = trim_blanks(_col(c).cast("string"))
    decimal = s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    value = F.when(decimal, s.try_cast("double"))
    for prefix, digits, bits in (("xX", "0-9a-fA-F", 4), ("oO", "0-7", 3), ("bB", "01", 1)):
        found = s.rlike(f"^0[{prefix}][{digits}]+$")
        value = value.when(found, _digits_value(F.substring(s, F.lit(3), F.length(s)), bits))
    return F.when(F.abs(value) < float("inf"), value)


def positive_integer(c: Column | str) -> Column:
    n = finite_number(c)
    return F.when((n > 0) & (n == F.rint(n)), n.try_cast("bigint"))


def topic_of(name: Column | str) -> Column:
    return trim_blanks(F.regexp_replace(_col(name), rf"^学习之旅\d+{BLANK}*", ""))


def sequence_of(name: Column | str) -> Column:
    return F.coalesce(F.regexp_extract(_col(name), r"学习之旅(\d+)", 1).try_cast("int"), F.lit(0))


def property_value(props: Column | str, name: str) -> Column:
    """Value of the first property with that name, else an empty string."""
    found = F.filter(_col(props), lambda p: p["paramName"] == name)
    return F.coalesce(F.try_element_at(found, F.lit(1))["paramValue"], F.lit(""))


def ensure_property(props: Column | str, name: str = "subjectId", value: str = "2") -> Column:
    """Append ``name=value`` unless the property is present."""
    have = F.coalesce(_col(props), F.array().cast("array<struct<paramName:string,paramValue:string>>"))
    extra = F.struct(F.lit(name).alias("paramName"), F.lit(value).alias("paramValue"))
    present = F.exists(have, lambda p: F.coalesce(p["paramName"] == name, F.lit(False)))
    return F.when(present, have).otherwise(F.concat(have, F.array(extra)))
