"""Page numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the largest roman page number, the pattern of a roman number, the roman digits
LARGEST_ROMAN = 50
ROMAN = "^m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
DIGITS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def parse_page(page: Column) -> Column:
    """The number a page label stands for: digits, or a strict roman number up to 50; null for anything else."""
    low = F.lower(page)
    digit = F.create_map(*(F.lit(x) for pair in DIGITS.items() for x in pair))
    values = F.transform(F.filter(F.split(low, ""), lambda c: c != ""), lambda c: F.element_at(digit, c))
    # a digit before a larger one is subtracted; seen from the right, so each is compared with the largest yet
    fold = F.aggregate(
        F.reverse(values),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top")),
        lambda a, v: F.struct((a["sum"] + F.when(v < a["top"], -v).otherwise(v)).alias("sum"), F.greatest(a["top"], v).alias("top")),
        lambda a: a["sum"],
    )
    roman = F.when((low != "") & low.rlike(ROMAN), fold)
    return F.when(page.rlike(r"^\p{Nd}+$"), page.try_cast("int")).otherwise(F.when(roman <= LARGEST_ROMAN, roman))


def normalize_page(value: Column) -> Column:
    """A label from a JSON scalar given as variant: numbers are cut to integers; -1, booleans and blanks are null."""
    kind = F.schema_of_variant(value)
    text = F.trim(F.try_variant_get(value, "$", "string"))
    number = F.try_variant_get(value, "$", "double").cast("long")
    is_number = kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    return F.when(is_number, F.when(number != -1, number.cast("string"))).when(kind == "STRING", F.when((text != "") & (F.lower(text) != "null"), text))


def printed_roman(page: Column) -> Column:
    return page.isNotNull() & ~page.rlike(r"^\p{Nd}+$") & parse_page(page).isNotNull()


def folded(page: Column) -> Column:
    return F.replace(F.replace(F.lower(page), F.lit("ß"), F.lit("ss")), F.lit("ſ"), F.lit("s"))


def page_key(page: Column) -> Column:
    """Equal for two labels just if they are equivalent: the same number, or the same text but for case. Null for null."""
    number = parse_page(page)
    return F.when(number.isNotNull(), F.concat(F.lit("n:"), number.cast("string"))).otherwise(F.concat(F.lit("c:"), folded(page)))


def page_order(page: Column) -> list[Column]:
    """Sort columns: nulls last, then number (0 if there is none), then label."""
    return [page.isNull(), F.coalesce(parse_page(page), F.lit(0)), F.coalesce(page, F.lit(""))]
