"""Text and cloze functions as Column expressions.

White space follows the ECMAScript definition (Unicode spaces and U+FEFF), which is wider than Spark's ``trim``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A gap is a run of two or more underscores; a numbered gap shows seven.
GAP = "_{2,}"
GAP_MARK = "_______"


#: White space as ECMAScript defines it.
WHITE = "\t\n\u000b\u000c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def trim_unicode(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE))


def normalize_space(c: Column) -> Column:
    """One space for every run of white space, none at the ends; a lone space of another kind than these stays."""
    spaced = F.regexp_replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), r"[\t\r\n\f]+", " ")
    return trim_unicode(F.regexp_replace(spaced, r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]{2,}", " "))


def normalize_lines(c: Column, lone_cr: bool = False) -> Column:
    """LF line ends (a lone CR too, if asked), single spaces, trimmed; line breaks stay."""
    lf = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    if lone_cr:
        lf = F.replace(lf, F.lit("\r"), F.lit("\n"))
    # only what isn't one space already is matched
    return trim_unicode(F.regexp_replace(lf, "[\t\u00a0][ \t\u00a0]*| [ \t\u00a0]+", " "))


def normalize_text(c: Column) -> Column:
    return trim_unicode(F.replace(c, F.lit("\r\n"), F.lit("\n")))


def literal_newlines(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit("\\n"))


def real_newlines(c: Column) -> Column:
    return F.replace(c, F.lit("\\n"), F.lit("\n"))


def count_gaps(c: Column) -> Column:
    return F.regexp_count(c, F.lit(GAP))


def between_gaps(c: Column, fills: Column) -> Column:
    """The text with its i-th gap replaced by the i-th of ``fills``, which has one for each gap.

    Both arrays are arguments of one zip, so each is made once a row, not once a gap.
    """
    return F.array_join(F.zip_with(F.split(c, GAP, -1), fills, lambda x, f: F.concat(F.coalesce(x, F.lit("")), F.coalesce(f, F.lit("")))), "")


def number_gaps(c: Column) -> Column:
    n = count_gaps(c)
    marks = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit(f"{GAP_MARK}("), i.cast("string"), F.lit(")")))
    return between_gaps(c, F.when(n > 0, marks).otherwise(F.array().cast("array<string>")))


def fill_gaps(c: Column, answers: Column) -> Column:
    return between_gaps(c, F.slice(F.coalesce(answers, F.array().cast("array<string>")), F.lit(1), count_gaps(c)))


def enumerate_join(items: Column) -> Column:
    """``1:a | 2:b``"""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(":"), x)), " | ")


def nonempty(items: Column, clean=trim_unicode) -> Column:
    """Cleaned items without empty ones; an empty array for a null."""
    return F.coalesce(F.filter(F.transform(items, lambda x: clean(F.coalesce(x, F.lit("")))), lambda x: x != ""), F.array().cast("array<string>"))


def join_sentences(items: Column) -> Column:
    return trim_unicode(F.array_join(items, "\n"))


def join_options(items: Column) -> Column:
    return F.array_join(items, "|")


def split_options(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", F.split(c, r"\|", -1)).otherwise(F.array().cast("array<string>"))


def json_strings(c: Column) -> Column:
    """Elements of a JSON array as text; null if it is no array."""
    return F.when(F.json_array_length(c).isNotNull(), F.from_json(c, "array<string>"))


def option_list(c: Column) -> Column:
    """Options given as a JSON array or as an object (its values, in order); anything else has none.

    Null, the number 0 and false are dropped, as are blank strings; the strings "0" and "false" are options like any other.
    """
    every = F.when(F.json_array_length(c).isNotNull(), F.from_json(c, "array<variant>"))
    values = F.map_values(F.when(F.ltrim(c).startswith("{"), F.from_json(c, "map<string,variant>")))
    return nonempty(F.transform(F.coalesce(every, values), told), normalize_space)


def told(v: Column) -> Column:
    """A JSON value as text; null for null, false and 0."""
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    falsy = (kind == "VOID") | ((kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(False))) | (~kind.isin("STRING", "BOOLEAN") & F.coalesce(number == 0, F.lit(False)))
    return F.when(~falsy, F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))


def csv_field(c: Column, always: bool = False) -> Column:
    """A field quoted where it has a quote, comma or line break, or always."""
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return quoted if always else F.when(c.rlike('[",\n\r]'), quoted).otherwise(c)


def explanation(kind: Column, difficulty: Column) -> Column:
    return F.concat(F.lit("Type: "), kind, F.lit(". Level: "), difficulty, F.lit("."))


def sorted_pair(a: Column, b: Column, between: str = " <-> ") -> Column:
    return F.array_join(F.array_sort(F.array(a, b)), between)


def rounded(c: Column, places: int) -> Column:
    """Half up on the binary value (10.075 is a little less, so it gives 10.07), as the source format's numbers are; not for negatives."""
    return F.floor(c * F.lit(10.0**places) + F.lit(0.5)) / F.lit(10.0**places)


def percent(value: Column, base: Column) -> Column:
    return rounded(F.when(base > 0, value * 100 / base).otherwise(F.lit(0.0)), 2)


def append_distinct(items: Column, extra: Column) -> Column:
    return F.array_distinct(F.concat(F.coalesce(items, F.array().cast("array<string>")), F.array(extra)))


def preview(c: Column, most: int = 40) -> Column:
    """The beginning of a text, for logs."""
    return F.substring(c, 1, most)
