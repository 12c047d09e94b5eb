"""

A list is an array column (one list per row); functions return Columns and run row-locally
inside whole-stage code, no Python.  Analytics that summarise many lists (F14-F16) are
grouped aggregates over a long (list_id, pos, value) table or over the array rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

# A JSON scalar: string (with escapes), number, true, false or null.  Brackets and commas
# between them only carry nesting, so the scalars in text order are the deep-flattened list.
JSON_SCALAR_RE = r'("(?:[^"\\]|\\.)*"|-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null)'


JSON_STRING_RE = r'"(?:[^"\\]|\\.)*"'


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def array_map(xs, f: Callable[[Column], Column]) -> Column:
    """F1."""
    return F.transform(_c(xs), f)


def array_filter(xs, pred: Callable[[Column], Column]) -> Column:
    """F2."""
    return F.filter(_c(xs), pred)


def array_flatten_deep(df: DataFrame, column: str) -> Column:
    """F3, typed: flatten an ``array<array<...>>`` column of any fixed depth to one level."""
    c, t = F.col(column), df.schema[column].dataType
    while isinstance(t, T.ArrayType) and isinstance(t.elementType, T.ArrayType):
        c, t = F.flatten(c), t.elementType
    return c


def json_flatten_deep(json_text, as_type: str | None = None) -> Column:
    """F3, mixed nesting: the scalars of a nested JSON array in order (``[[1],[2,[3,[4]]],5]``
    -> ``[1,2,3,4,5]``), as JSON texts or cast to ``as_type``.

    With ``as_type``, JSON null is a null element, and so is a scalar of another type.  A text with an object
    in it is not a nested list: its result is null."""
    text = _c(json_text)
    toks = F.regexp_extract_all(text, F.lit(JSON_SCALAR_RE), 1)
    if as_type == "variant":
        toks = F.transform(toks, lambda t: F.parse_json(t))
    elif as_type is not None:
        toks = F.transform(toks, lambda t: F.nullif(t, F.lit("null")).try_cast(as_type))
    bare = F.regexp_replace(text, JSON_STRING_RE, "")
    return F.when(~bare.contains("{"), toks)


def array_fold_left(xs, init, f: Callable[[Column, Column], Column]) -> Column:
    """f(...f(f(init, x1), x2)..., xn)."""
    return F.aggregate(_c(xs), F.lit(init) if not isinstance(init, Column) else init, f)


def array_fold_right(xs, init, f: Callable[[Column, Column], Column]) -> Column:
    """f(x1, f(x2, ... f(xn, init)))."""
    init = F.lit(init) if not isinstance(init, Column) else init
    return F.aggregate(F.reverse(_c(xs)), init, lambda acc, x: f(x, acc))


def array_zip_shortest(xs, ys) -> Column:
    """pairs up to the shorter list (``arrays_zip`` alone pads with nulls)."""
    m = F.least(F.size(_c(xs)), F.size(_c(ys)))
    return F.arrays_zip(F.slice(_c(xs), 1, m), F.slice(_c(ys), 1, m))


def array_first_n(xs, n) -> Column:
    """the first n elements; n <= 0 gives an empty list."""
    n = F.lit(n) if not isinstance(n, Column) else n
    return F.slice(_c(xs), 1, F.greatest(n, F.lit(0)))


def list_max(xs) -> Column:
    """F8: maximum; null for an empty list."""
    return F.array_max(_c(xs))


def per_list(items: DataFrame, key: str = "list_id", value: str = "value") -> DataFrame:
    """F8-F10 on the long (list_id, pos, value) form: per list the maximum (null when the list
    has no defined value), the sum (nulls skipped, 0 when none) and the number of defined values."""
    v = F.col(value)
    return items.groupBy(key).agg(F.max(v).alias("max"),
                                  F.coalesce(F.sum(v.cast("bigint")), F.lit(0).cast("bigint")).alias("sum"),
                                  F.count(v).alias("defined"))


def list_sum(xs) -> Column:
    """sum as bigint; 0 for an empty list."""
    return F.aggregate(_c(xs), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def list_sum_defined(xs) -> Column:
    """sum of the defined (non-null) values."""
    return F.aggregate(_c(xs), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x.cast("bigint"), F.lit(0)))


def list_first_divisible(xs, n: int) -> Column:
    """first element divisible by n, null if none."""
    return F.get(F.filter(_c(xs), lambda x: x % n == 0), 0)


def list_even_defined(xs) -> Column:
    """the defined, even elements."""
    return F.filter(_c(xs), lambda x: x.isNotNull() & (x % 2 == 0))


def list_avg_first_n_above(xs, x: int, n: int) -> Column:
    """integer average of the first n elements greater than x; null when there are none."""
    s = F.slice(F.filter(_c(xs), lambda v: v > x), 1, n)
    return F.when(F.size(s) > 0, F.call_function("div", list_sum(s), F.size(s).cast("bigint")))


def list_sum_first_n_above(xs, n: int = K.FIRST_ABOVE_N, x: int = K.FIRST_ABOVE_X) -> Column:
    """F14 on an array column."""
    return list_sum(F.slice(F.filter(_c(xs), lambda v: v > x), 1, n))


def sum_first_n_above(items: DataFrame, n: int = K.FIRST_ABOVE_N, x: int = K.FIRST_ABOVE_X, key: str = "list_id", pos: str = "pos",
                      value: str = "value") -> DataFrame:
    """F14 grouped form: per list, the sum of its first ``n`` values greater than ``x``; 0 for a list
    without such values.

    Values above ``x`` are numbered first, so every list keeps a row.  ``row_number() <= n`` lets
    Catalyst insert a map-side group limit, so a huge list ships at most ``n`` rows per task into
    the shuffle."""
    above = F.coalesce(F.col(value) > x, F.lit(False))
    w = Window.partitionBy(key).orderBy(above.desc(), pos)
    first = items.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max(n, 1))
    counted = F.when(above & (F.col("_rn") <= n), F.col(value).cast("bigint")).otherwise(F.lit(0))
    return first.groupBy(key).agg(F.sum(counted).alias("total"))


def passing_students(grades: DataFrame, student: str = "student_id", grade: str = "grade",
                     min_avg: float = K.PASS_AVERAGE, min_grade: int = K.PASS_MIN_GRADE) -> DataFrame:
    """number of students whose average is >= ``min_avg`` and no grade below ``min_grade``.
    A student without grades does not pass (D23)."""
    per = grades.groupBy(student).agg(F.sum(grade).alias("_s"), F.count(grade).alias("_n"),
                                      F.min(grade).alias("_min"))
    ok = (F.col("_n") > 0) & (F.col("_s") >= F.lit(min_avg) * F.col("_n")) & (F.col("_min") >= min_grade)
    return per.agg(F.count_if(ok).alias("passing"))


def first_head_sums_tail(lists: DataFrame, xs: str = "xs", key: str = "list_id") -> DataFrame:
    """F16: size of the first list (by ``key``) whose head equals the sum of the rest; one row, null if none."""
    arr = F.col(xs)
    hit = lists.filter((F.size(arr) >= 1) & (F.get(arr, 0).cast("bigint") == list_sum(F.slice(arr, 2, F.size(arr)))))
    return hit.agg(F.min_by(F.size(arr).cast("bigint"), F.col(key)).alias("size"))


def fizzbuzz_label(n) -> Column:
    """FizzBuzz / Buzz / Fizz / the number as text."""
    n = _c(n)
    fz, bz = K.FIZZ_DIVISOR, K.BUZZ_DIVISOR
    return (F.when((n % fz == 0) & (n % bz == 0), F.lit(K.FIZZBUZZ))
            .when(n % bz == 0, F.lit(K.BUZZ)).when(n % fz == 0, F.lit(K.FIZZ))
            .otherwise(n.cast("string")))
