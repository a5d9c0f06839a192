"""Text cleaning and extraction as JVM column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# The patterns, labels and defaults the results depend on.
WEIGHT_PATTERN = r"(\d+(?:[.,]\d+)?)\s*(g|kg|lb|lbs|oz|ml|L|cc|lt)\b"
PRESENTATION_PATTERN = r"\b(lata|bolsa|caja|sobre|frasco|tarro|tubo|paquete)\b"
PRICE_SUBSTITUTIONS = [(r"[\$,]", ""), (r"\s+", "")]
SCRAPED_PRICE_SUBSTITUTIONS = [(r"[$]", ""), (r"[\n]", ""), (r"Precio actual", ""), (r"[,]", "")]
MISSING_PRICE = "$0.00"
OTHER_LABEL = "OTRO"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def java_replacement(text: str) -> str:
    r"""Turn a Python replacement (``\1``, ``\g<name>``) into a Java one."""
    out = text.replace("$", r"\$")
    out = re.sub(r"\\g<(\w+)>", lambda m: "$" + (m[1] if m[1].isdigit() else "{" + m[1] + "}"), out)
    return re.sub(r"\\(\d+)", r"$\1", out)


def java_pattern(pattern: str) -> str:
    r"""Turn a Python pattern into a Java one: named groups, and ``\w``, ``\d``, ``\s``, ``\b`` of all languages."""
    out = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", pattern)
    return "(?U)" + re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", out)


def to_number(c: Column) -> Column:
    """Strict text-to-double: plain decimal notation or NULL."""
    return F.when(c.rlike(_NUMBER), F.trim(c)).try_cast("double")


def clean_text(c: Column) -> Column:
    """Collapse runs of (Unicode) white space to one blank and trim."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def parse_price(c: Column) -> Column:
    """First run of digits, commas and points, commas removed; NULL when unparsable."""
    return to_number(F.replace(F.regexp_extract(c, r"[\d,.]+", 0), F.lit(","), F.lit("")))


def substitute(c: Column, substitutions) -> Column:
    """Ordered regular-expression replacements (Python replacement syntax)."""
    for pattern, replacement in substitutions:
        c = F.regexp_replace(c, java_pattern(pattern), java_replacement(replacement))
    return c


def clean_columns(df: DataFrame, columns, substitutions) -> DataFrame:
    """Apply the replacements to each named column; names not in the table are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: substitute(F.col(c).cast("string"), substitutions) for c in present})


def clean_prices(df: DataFrame, columns, substitutions=None) -> DataFrame:
    """Replacements, then numeric; what is not a number becomes NULL."""
    rules = PRICE_SUBSTITUTIONS if substitutions is None else substitutions
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(substitute(F.col(c).cast("string"), rules)) for c in present})


def matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Keep rows whose non-empty text contains the pattern."""
    return df.where((F.col(column) != "") & F.col(column).rlike(java_pattern(pattern)))


def extract_groups(df: DataFrame, column: str, patterns: dict[str, str],
                   strip: bool = True) -> DataFrame:
    """One column per pattern (its first group); only rows on which all patterns hit."""
    hit = F.col(column) != ""
    for pattern in patterns.values():
        hit = hit & F.col(column).rlike(java_pattern(pattern))
    found = {}
    for name, pattern in patterns.items():
        group = F.regexp_extract(F.col(column), java_pattern(pattern), 1)
        found[name] = F.regexp_replace(group, r"(?U)^\s+|\s+$", "") if strip else group
    return df.where(hit).withColumns(found)


def weight_number(c: Column) -> Column:
    return to_number(F.replace(F.regexp_extract(c, "(?i)" + WEIGHT_PATTERN, 1), F.lit(","), F.lit(".")))


def weight_unit(c: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(c, "(?i)" + WEIGHT_PATTERN, 2), F.lit("")))


def presentation(c: Column) -> Column:
    """First packaging word of a product name."""
    return F.nullif(F.regexp_extract(c, "(?i)" + PRESENTATION_PATTERN, 1), F.lit(""))


def split_lines(c: Column) -> Column:
    """Non-breaking spaces to blanks, then one array element per line."""
    return F.split(F.replace(c, F.lit("\u00a0"), F.lit(" ")), "\n")


def parse_fixtures(df: DataFrame, column: str) -> DataFrame:
    """Sports lines ``- competition: home vs. away`` to three columns."""
    line = F.replace(F.col(column), F.lit("\u00a0"), F.lit(" "))
    lines = df.withColumn("_line", line).where(F.col("_line").rlike("vs."))
    after_dash = F.regexp_extract("_line", "-(.+)", 1)
    return lines.withColumns({
        "competition": F.regexp_extract("_line", "-(.+):", 1),
        "home": F.regexp_extract(after_dash, ":(.+)vs", 1),
        "away": F.regexp_extract("_line", "vs.(.+)", 1)}).drop("_line")


def strip_seeding(c: Column) -> Column:
    """Remove parentheses and digits from a name."""
    return F.regexp_replace(c, r"[()]|\d+", "")


def default_price(c: Column) -> Column:
    """Missing, empty or range prices become the zero price."""
    return F.when(c.isNull() | (c == "") | c.contains("-"), F.lit(MISSING_PRICE)).otherwise(c)


def largest_integer(c: Column) -> Column:
    """Largest run of digits in the text, NULL when there is none."""
    digits = F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0))
    return F.array_max(F.transform(digits, lambda d: d.try_cast("bigint")))


def page_urls(df: DataFrame, base: str, total: str, placeholder: str = "{page}",
              start: int = 1, out: str = "url") -> DataFrame:
    """One row per page: the placeholder of ``base`` replaced by start .. start+total-1."""
    last = F.col(total) + F.lit(start - 1)
    pages = df.where(F.col(total) > 0).withColumn("page", F.explode(F.sequence(F.lit(start).cast("bigint"), last.cast("bigint"))))
    return pages.withColumn(out, F.replace(F.col(base), F.lit(placeholder), F.col("page").cast("string")))


def replace_empty(df: DataFrame, columns, label: str = OTHER_LABEL) -> DataFrame:
    """Empty strings become the label; NULL stays NULL."""
    return df.withColumns({c: F.when(F.col(c) == "", F.lit(label)).otherwise(F.col(c)) for c in columns})


def price_range(c: Column, low: float = 5000, high: float = 25000) -> Column:
    """BAJO below ``low``, MEDIO below ``high``, else ALTO."""
    return F.when(c < low, "BAJO").when(c < high, "MEDIO").when(c.isNotNull(), "ALTO")
