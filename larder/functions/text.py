"""Attribute-id slugs and the printed nutrition list, as SQL expressions.

Expressions are SQL text, so that nested ones cost one parse instead of many
calls into the JVM.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tokens of a printed list: quoted strings first, so that nothing inside them is taken for a bracket or a name.
LIST_TOKEN = r"""("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[A-Za-z_]+|[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?|\S)"""
NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
# Text that JSON reads differently from the printed list: tuples, single quotes, None, open commas, bare signs and dots.
NOT_JSON = r"""[('+\\]|None|,\s*\]|[^0-9]\.[0-9]|[0-9]\.[^0-9]"""
TASKS_PER_CORE = 4

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(e: str) -> str:
    """Remove leading and trailing white space of any kind (plain trim() removes blanks only)."""
    return f"trim(BOTH '{WHITE_SPACE}' FROM {e})"


def slug(prefix: str, e: str) -> str:
    """prefix + value with each blank as '_', lower-cased."""
    return f"concat('{prefix}', lower(replace({e}, ' ', '_')))"


def code(prefix: str, e: str) -> str:
    """prefix + value as text, unchanged."""
    return f"concat('{prefix}', cast({e} AS string))"


def _as_json(text: Column) -> Column:
    """A printed list as JSON: tuples become lists, numbers and both kinds of quotes JSON strings, None null."""
    found = F.regexp_extract_all(text, F.lit(LIST_TOKEN), F.lit(1))

    def json(t: Column) -> Column:
        inner = F.substring(t, F.lit(2), F.length(t) - 2)
        plain = F.replace(inner, F.lit("\\'"), F.lit("'"))
        return (
            F.when(t == "(", "[").when(t == ")", "]").when(t == "None", "null")
            .when(F.startswith(t, F.lit("'")), F.concat(F.lit('"'), F.regexp_replace(plain, r'(?<!\\)"', r'\\"'), F.lit('"')))
            .when(F.startswith(t, F.lit('"')), F.concat(F.lit('"'), plain, F.lit('"')))
            .when(t.rlike(NUMBER), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t)
        )

    def listed(tokens: Column) -> Column:
        closing = lambda i: F.coalesce(F.get(tokens, i + 1).isin("]", ")"), F.lit(False))
        kept = F.filter(tokens, lambda t, i: ~((t == ",") & closing(i)))
        return F.array_join(F.transform(kept, json), " ")

    # The tokens are bound as the one element of an array, so that they are not found again for each of them.
    return F.get(F.transform(F.array(found), listed), F.lit(0))


def with_nutrition_pairs(items: DataFrame, column: str = "nutrition_nm", out: str = "_pairs") -> DataFrame:
    """Parse a printed list of [name, value] pairs into array<struct<name string, value double>>.

    Lists and tuples, both kinds of quotes, None and open commas are read. Null, junk, or any element that is not a
    pair gives an empty array; a value that is no number gives null; of two entries with one name the last stays.
    """
    text = F.when(F.col(column).rlike(NOT_JSON), _as_json(F.col(column))).otherwise(F.col(column))
    name = f"lower({strip_space('get(e, 0)')})"
    value = f"CASE WHEN rlike(get(e, 1), r'{NUMBER}') THEN try_cast(trim(get(e, 1)) AS double) END"
    pairs = f"""
        CASE WHEN _rows IS NULL OR exists(_rows, e -> e IS NULL OR size(e) <> 2 OR get(e, 0) IS NULL)
             THEN cast(array() AS array<struct<name: string, value: double>>)
             ELSE transform(_rows, e -> named_struct('name', {name}, 'value', {value})) END"""
    last = f"filter({out}, (e, i) -> NOT exists(slice({out}, i + 2, size({out})), x -> x.name = e.name))"
    # Reading the text takes far longer than reading the file, so rows are dealt to all cores, however few pieces the file has.
    dealt = items.repartition(TASKS_PER_CORE * items.sparkSession.sparkContext.defaultParallelism)
    return (
        dealt.withColumn("_rows", F.from_json(text, "array<array<string>>"))
        .withColumn(out, F.expr(pairs))
        .withColumn(out, F.expr(last))
        .drop("_rows")
    )


def nutrient_value(name: str, pairs: str = "_pairs") -> str:
    """Value of one nutrient, null when it is absent."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"get(filter({pairs}, e -> e.name = '{quoted}'), 0).value"
