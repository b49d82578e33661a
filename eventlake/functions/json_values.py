"""Reading one field of a parsed JSON document, with strict or lenient coercion.

Most payloads hold what is declared, or text that says the same. ``texts`` reads the fields of
those as text with one ``from_json``, and ``quick`` casts them. Where that does not settle a
field (null and missing look alike, a fraction or an object loses its form) the payload is
parsed again, to a VARIANT document. There ``raw`` reads a field as its declared type, ``kind``
adds the JSON type where that read does not settle the answer, and ``strict`` or ``lenient``
turns the pair into the value:

=====================  ==========================  =========================
JSON value             strict                      lenient
=====================  ==========================  =========================
missing                NULL (the row is rejected)  NULL
null                   ``"null"`` / 0              NULL
object or array        ``""`` / 0                  JSON text / NULL
number out of range    NULL (the row is rejected)  NULL
text that is a number  the number, ``7.9`` as 7    the number, ``7.9`` as NULL
other text             0                           NULL
boolean as number      1 / 0                       NULL
=====================  ==========================  =========================

The functions return SQL text: a decode has hundreds of expression nodes, and handing Spark one
text per column is far quicker than building each node from Python, for every micro-batch.
"""

from __future__ import annotations

from eventlake.schemas import Field, json_struct

PLAIN = "PLAIN"
CORRUPT = "__corrupt"

# Text that may come from a JSON object, array or fraction, which strict reading writes another
# way. (A number too large for a double comes out in quotes.)
_NOT_RAW = r"""^(?:["{\\[]|-0|-?[0-9]+[.eE])"""

# Whole numbers too long for BIGINT: scale 0 and 19 digits or more.
_LONG_WHOLE = r"^DECIMAL\\((19|[23]\\d),0\\)$"


def texts(payload: str, fields: tuple[Field, ...]) -> str:
    """The fields of a payload as text, nested like the document. No value fails this read;
    ``CORRUPT`` is set where the payload is no JSON object or nests differently."""
    schema = json_struct(fields).add(CORRUPT, "string").simpleString()
    return f"""from_json({payload}, '{schema}', map(
        'columnNameOfCorruptRecord', '{CORRUPT}',
        'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false'))"""


def json_type(document: str, path: str) -> str:
    """JSON type of a field as Spark names it; NULL where the field is missing."""
    return f"schema_of_variant(try_variant_get({document}, '{path}', 'variant'))"


def _starts_with_letter(text: str) -> str:
    return f"({text} >= 'a' AND {text} < '{{' OR {text} >= 'A' AND {text} < '[')"


def _looks_like(text: str, type_: str) -> str:
    """A cheap look before the cast: one that fails is costly, and its text is left to the
    document anyway."""
    number = f"{text} >= '-' AND {text} < ':'"
    return number if type_ == "double" else f"{number} AND NOT contains({text}, '.')"


def quick(text: str, field: Field) -> str:
    """The value, if it is the same however the text was written in JSON; else NULL."""
    if field.type == "string":
        return f"CASE WHEN {_starts_with_letter(text)} OR NOT {text} RLIKE '{_NOT_RAW}' THEN {text} END"
    return f"CASE WHEN {_looks_like(text, field.type)} THEN try_cast({text} AS {field.type}) END"


def raw(document: str, field: Field) -> str:
    return f"try_variant_get({document}, '{field.path}', '{field.type}')"


def kind(document: str, field: Field, value: str) -> str:
    """``PLAIN`` where ``value`` can be used as it is, else the JSON type of the field."""
    if field.type == "string":
        # Text that starts with a letter is neither a number nor a container.
        settled = _starts_with_letter(value)
    else:
        # 0 and 1 may have been read from a boolean.
        settled = f"({value} IS NOT NULL AND {value} NOT IN (0, 1))"
    return f"CASE WHEN {settled} THEN '{PLAIN}' ELSE {json_type(document, field.path)} END"


def _is_container(kind_: str) -> str:
    return f"(startswith({kind_}, 'OBJECT') OR startswith({kind_}, 'ARRAY'))"


def _number_text(document: str, field: Field, value: str, kind_: str) -> str:
    # A fraction is written as a double (1.0, not 1); a whole number keeps its digits.
    fraction = (
        f"({kind_} = 'DOUBLE' OR startswith({kind_}, 'DECIMAL') "
        f"AND NOT {kind_} RLIKE '{_LONG_WHOLE}')"
    )
    as_double = f"cast(try_variant_get({document}, '{field.path}', 'double') AS string)"
    return f"CASE WHEN {fraction} THEN {as_double} ELSE {value} END"


def strict(document: str, field: Field, value: str, kind_: str) -> str:
    if field.type == "string":
        return f"""CASE
            WHEN {kind_} = '{PLAIN}' THEN {value}
            WHEN {kind_} = 'VOID' THEN 'null'
            WHEN {_is_container(kind_)} THEN ''
            ELSE {_number_text(document, field, value, kind_)} END"""
    zero = f"cast(0 AS {field.type})"
    if field.type == "double":
        coerced = zero
    else:
        as_double = f"try_variant_get({document}, '{field.path}', 'double')"
        coerced = f"coalesce(try_cast({as_double} AS {field.type}), {zero})"
    return f"""coalesce({value}, CASE
        WHEN {kind_} IN ('STRING', 'VOID') OR {_is_container(kind_)} THEN {coerced} END)"""


def lenient(document: str, field: Field, value: str, kind_: str) -> str:
    if field.type == "string":
        return f"""CASE
            WHEN {kind_} = '{PLAIN}' OR {_is_container(kind_)} THEN {value}
            WHEN {kind_} = 'VOID' THEN NULL
            ELSE {_number_text(document, field, value, kind_)} END"""
    return f"CASE WHEN {kind_} <> 'BOOLEAN' THEN {value} END"
