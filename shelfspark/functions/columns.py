"""Column-level helpers shared by the silver and gold plans.

All of them return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Default labels for missing attributes and the yes / no labels.
NOT_DEFINED_F = "NÃO DEFINIDA"
NOT_DEFINED_M = "NÃO DEFINIDO"
YES, NO = "SIM", "NÃO"


def opt(df: DataFrame, name: str, dtype: DataType | str) -> Column:
    """Column ``name`` cast to ``dtype``; a typed NULL when the source lacks it.

    Raw extracts differ in which optional columns they carry; the staging
    functions read every column through this so a narrower extract still loads.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        return F.col(name).cast(dtype)
    return F.lit(None).cast(dtype)


def decode(c: Column, mapping: Mapping[str, str], default: Column | str | None = "upper") -> Column:
    """Code -> label on the upper-cased code.

    ``default="upper"`` keeps the raw upper-cased code for unknown values (and
    NULL for NULL); a string default is used for unknown codes *and* NULL, as a
    ``CASE ... ELSE`` does.
    """
    key = F.upper(c)
    expr = None
    for code, label in mapping.items():
        expr = (F.when(key == F.lit(code), F.lit(label)) if expr is None
                else expr.when(key == F.lit(code), F.lit(label)))
    if default == "upper":
        fallback = key
    elif isinstance(default, Column):
        fallback = default
    else:
        fallback = F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def yes_no(c: Column, yes_code: str = "S") -> Column:
    """'SIM' when the upper-cased flag equals ``yes_code``, else 'NÃO' (NULL too)."""
    return F.when(F.upper(c) == F.lit(yes_code), F.lit(YES)).otherwise(F.lit(NO))


def padded(c: Column, width: int, fill: str = "0") -> Column:
    """``LPAD(c::TEXT, width, fill)``; truncates longer values like PostgreSQL does."""
    return F.lpad(c.cast("string"), width, fill)


def id_label(id_col: Column, name_col: Column, width: int) -> Column:
    """'0042 - NAME' label of an id and its upper-cased name."""
    return F.concat(padded(id_col, width), F.lit(" - "), F.upper(name_col))


def nullif(c: Column, value=0) -> Column:
    return F.when(c == F.lit(value), F.lit(None)).otherwise(c)


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of a division-by-zero error."""
    return num / nullif(den, 0)


def abc_class(acum: Column, total: Column, a: str = "0.80", b: str = "0.95") -> Column:
    """Pareto class of a running share ``acum / total``.

    A up to ``a``, B up to ``b``, otherwise C (also for a zero or NULL total).
    The comparison is done by multiplication on decimals, so a share exactly
    on a threshold is classified exactly; a negative total flips the sense.
    """
    ta, tb = F.lit(a).cast("decimal(4,2)"), F.lit(b).cast("decimal(4,2)")
    pos, neg = total > 0, total < 0
    in_a = (pos & (acum <= ta * total)) | (neg & (acum >= ta * total))
    in_b = (pos & (acum <= tb * total)) | (neg & (acum >= tb * total))
    return F.when(in_a, "A").when(in_b, "B").otherwise("C")


def share_pct(acum: Column, total: Column, digits: int = 4) -> Column:
    """Rounded running share as a double; NULL for a zero total."""
    return F.round(safe_div(acum.cast("double"), total.cast("double")), digits)


def half_even_int(c: Column) -> Column:
    """``double::INTEGER`` of PostgreSQL: round half to even, then integer."""
    return F.bround(c, 0).cast("int")
