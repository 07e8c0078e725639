"""Masks for personal data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mask_email(email: Column) -> Column:
    """Two leading characters and the domain stay readable."""
    at = F.instr(email, "@")
    masked = F.concat(
        F.left(F.substring_index(email, "@", 1), F.lit(2)),
        F.lit("***@"),
        F.substring(email, at + 1, F.length(email)),
    )
    return F.when(at > 0, masked).when(email.isNotNull(), "***")


def _last_four(text: Column, prefix: str, short: str) -> Column:
    """The last four digits behind a prefix, or `short` when there are fewer.

    A chain of replacements reads the text once; a CASE would evaluate it per branch.
    """
    digits = F.regexp_replace(text, "[^0-9]+", "")
    shown = F.regexp_replace(digits, "^[0-9]*([0-9]{4})$", f"{prefix}$1")
    return F.regexp_replace(shown, "^[0-9]{0,3}$", short)


def mask_phone(phone: Column) -> Column:
    return _last_four(phone, "***-***-", "***")


def mask_card(card: Column) -> Column:
    return _last_four(card, "****-****-****-", "****")


MASKS = {"email": mask_email, "phone": mask_phone, "credit_card": mask_card}


def mask_customer_data(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Mask every personal column that exists; `columns` maps a column to a mask name."""
    wanted = columns or {name: name for name in MASKS}
    return df.withColumns(
        {name: MASKS[kind](F.col(name)) for name, kind in wanted.items() if name in df.columns}
    )


# Personal data inside free text, and what is left of each match. A match begins where a word does;
# the look-behinds and possessive runs keep one start for each word, so long unbroken text costs
# linear time. Cards are replaced first, since their groups of digits could pass for a number to call.
_START, _END = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"
TEXT_MASKS = (
    (f"{_START}(?:[0-9]{{4}}[ -]?){{3}}([0-9]{{4}}){_END}", "****-****-****-$1"),
    (
        rf"(?:\+[0-9]{{1,3}}[ .-]?)?(?:\([0-9]{{3}}\)|{_START}[0-9]{{3}})[ .-][0-9]{{3}}[ .-]([0-9]{{4}}){_END}",
        "***-***-$1",
    ),
    ("(?<![a-zA-Z0-9._%+-])([a-zA-Z0-9._%+-]{1,2}+)[a-zA-Z0-9._%+-]*+@([a-zA-Z0-9.-]+)", "$1***@$2"),
)


def mask_text(text: Column) -> Column:
    """Every card number, phone number and mail address inside a text, masked; the rest stays."""
    for pattern, shown in TEXT_MASKS:
        text = F.regexp_replace(text, pattern, shown)
    return text


def mask_value(value: Column, kind: T.DataType, name: str, fields: Mapping[str, str]) -> Column:
    """A value of any type with all personal data in it masked.

    Structs, arrays and map values are walked; a text under one of the names in `fields` is masked
    whole by that mask, whether the name is a column, a struct field or a map key, and any other text
    has the matches inside it replaced. Map keys and values that are no text stay as they are.
    """
    if isinstance(kind, T.StringType):
        mask = fields.get(name.lower())
        return MASKS[mask](value) if mask else mask_text(value)
    if isinstance(kind, T.StructType):
        inside = [mask_value(value.getField(f.name), f.dataType, f.name, fields).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*inside)) if inside else value
    if isinstance(kind, T.ArrayType):
        # The elements of `email: array<string>` are addresses as well.
        return F.transform(value, lambda item: mask_value(item, kind.elementType, name, fields))
    if isinstance(kind, T.MapType):

        def held(key, item):
            masked = mask_value(item, kind.valueType, name, fields)
            if not isinstance(kind.keyType, T.StringType) or not isinstance(kind.valueType, T.StringType):
                return masked
            for field, mask in fields.items():
                masked = F.when(F.lower(key) == field, MASKS[mask](item)).otherwise(masked)
            return masked

        return F.transform_values(value, held)
    return value


def mask_everywhere(
    df: DataFrame, fields: Mapping[str, str] | None = None, skip: Sequence[str] = ()
) -> DataFrame:
    """Mask personal data in every column of any depth, free text included; columns in `skip` stay.

    `fields` maps names (in lower case) to masks, by default the names of the masks themselves.
    """
    wanted = {name.lower(): kind for name, kind in (fields or {name: name for name in MASKS}).items()}
    unknown = sorted(set(wanted.values()) - set(MASKS))
    if unknown:
        raise ValueError(f"unknown masks: {', '.join(unknown)}")
    return df.select(
        *(
            F.col(f"`{f.name}`") if f.name in skip else mask_value(F.col(f"`{f.name}`"), f.dataType, f.name, wanted).alias(f.name)
            for f in df.schema
        )
    )
