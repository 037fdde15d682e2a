"""Masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MASK = "***"
_BLANKS = " \t\n\r\f\v"


def mask_email(column: str) -> Column:
    """First character of the local part and the domain; a bare mask for anything malformed."""
    clean = F.lower(F.btrim(F.col(column), F.lit(_BLANKS)))
    masked = F.concat(
        F.substring(clean, 1, 1),
        F.lit(MASK),
        F.substring(clean, F.instr(clean, "@"), F.length(clean)),
    )
    return F.when(clean.rlike("(?s)^[^@]+@.+"), masked).when(clean.isNotNull(), F.lit(MASK))


def mask_name(column: str) -> Column:
    """First character of every word; NULL stays NULL and blank becomes empty."""
    words = F.filter(F.split(F.col(column), r"\s+"), lambda word: word != "")
    return F.array_join(
        F.transform(words, lambda word: F.concat(F.substring(word, 1, 1), F.lit(MASK))), " "
    )


def mask_customers(df: DataFrame) -> DataFrame:
    """Mask whichever personal columns are present and pass all others through."""
    maskers = {"customer_name": mask_name, "email": mask_email}
    present = {name: mask(name) for name, mask in maskers.items() if name in df.columns}
    return df.withColumns(present) if present else df
