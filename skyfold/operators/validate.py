"""Record validation and typed extraction, as column expressions.

Each record (a variant) is checked against ``schemas.RECORD_SPEC``: every
field required, values coerced the lax way (numbers in text, whole floats as
ints, yes/no words as booleans), giving a ``violations array<string>``.
Valid records are then cast to the typed record struct. All of it runs
inside the JVM, row by row, with no Python and no shuffle.

Casting a variant leaf costs many times what looking at a text does. So every leaf
is cast once, to text, and a part of a record all of whose texts are of an
accepted form, whatever their JSON type, is accepted and typed from these texts.
The texts of an object are first matched together, by one pattern of the common
forms, then one by one. Only other parts are looked at as variants, and there only
the leaves whose own text is not accepted.

Modes: ``"fail"`` stops the job at the first invalid record (the batch is
all or nothing); ``"quarantine"`` keeps invalid records aside with their
violations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

# Variant types read as whole numbers, and other numbers
# (DECIMAL(p,s) is matched by its prefix).
INTEGRAL_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
FLOATING_TYPES = ("DOUBLE", "FLOAT")
DECIMAL_PREFIX = "DECIMAL"

# Top-level parts of a record, extracted once before the checks: raw
# variants, and cast to their struct-of-variants shape.
PART_PREFIX = "_part_"
SHAPED_PREFIX = "_shaped_"
# All leaves of a record as texts, and of each part whether these are accepted;
# the variants above are only extracted for parts of which they are not.
TEXTS = "_texts"
PLAIN_PREFIX = "_plain_"

# Ranges of the integer column types.
INT_RANGES = {"int": (-(2 ** 31), 2 ** 31 - 1), "bigint": (-(2 ** 63), 2 ** 63 - 1)}

# Words accepted as booleans (compared in lower case).
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")

# Text patterns.
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*(\.0*)?\s*$"
NUMBER_TEXT = (r"(?i)^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$"
               r"|^(true|false)$")
ZONE_TEXT = r"\s*(Z|z|[+-]\d{2}(:?\d{2})?)"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}([Tt ]00:00(:00(\.0+)?)?" + ZONE_TEXT + r"?)?$"
NAIVE_DATETIME_TEXT = r"^\d{4}-\d{2}-\d{2}([Tt ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"
AWARE_DATETIME_TEXT = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?" + ZONE_TEXT + "$"

# The common forms of numbers, which need no further test (the digits fit
# the type), and texts that a leaf of another JSON type than string may also have.
PLAIN_NUMBER = r"^-?\d{1,15}(\.\d{1,15})?\z"
PLAIN_INT = {"int": r"^-?\d{1,9}\z", "bigint": r"^-?\d{1,18}\z"}
MAYBE_NO_STRING = r"^([-0-9\[{]|(true|false)$)"
# The common forms of every kind of leaf, for one pattern over all leaves of
# an object, and the character that ends each of them there (no form holds it).
END = "\x01"
_DAY = (r"[1-9]\d{3}-(?:(?:0[13578]|1[02])-(?:0[1-9]|[12]\d|3[01])|(?:0[469]|11)-(?:0[1-9]|[12]\d|30)"
        r"|02-(?:0[1-9]|1\d|2[0-8]))")
COMMON = {
    "str": r"(?!(?:true|false)\x01)(?:[^-0-9\[{\x01][^\x01]*+)?+",
    "float": r"-?\d{1,30}+(?:\.\d{1,30}+)?(?:[eE][-+]?\d{1,3}+)?",
    "int": r"-?\d{1,9}+",
    "bigint": r"-?\d{1,18}+",
    "bool": r"(?i:true|false|yes|no|on|off|[tfyn01])",
    "date": _DAY,
    "datetime": _DAY + r"[ T](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,6}+)?)?",
}

# The field whose zone is another field, so that it must have
# none itself, and the field that names a zone.
LOCAL_FIELD, ZONE_FIELD = "localtime", "tz_id"
# Numbers above this are milliseconds, others seconds since 1970.
MILLISECONDS_ABOVE, DAY_SECONDS = 2e10, 86400


def _get(v: Column, path: str = "$", to: str = "variant") -> Column:
    return F.try_variant_get(v, path, to)


def _type(x: Column) -> Column:
    return F.schema_of_variant(x)


def _missing(x: Column) -> Column:
    return x.isNull() | F.is_variant_null(x)


def _is_object(x: Column) -> Column:
    # casting to an empty struct succeeds exactly for objects, and is cheap
    # (schema_of_variant would print the whole nested type)
    return _get(x, to="struct<>").isNotNull()


def _numeric(t: Column) -> Column:
    return t.isin(*INTEGRAL_TYPES, *FLOATING_TYPES) | t.startswith(DECIMAL_PREFIX)


def _number(x: Column) -> Column:
    """The number in a variant: a number, a boolean, or text, whose digits ``_`` may group."""
    return F.coalesce(_get(x, to="double"), F.replace(_get(x, to="string"), F.lit("_"), F.lit("")).try_cast("double"))


def _since_1970(x: Column) -> Column:
    """Seconds since 1970 in a variant that is a number or numeric text, else null."""
    d = F.when(_get(x, to="string").rlike(NUMBER_TEXT) & (_type(x) != "BOOLEAN"), _number(x))
    return F.when(F.abs(d) > MILLISECONDS_ABOVE, d / 1000).otherwise(d)


def _wall_clock(seconds: Column) -> Column:
    """UTC wall clock of seconds since 1970."""
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(secs=F.round(seconds.cast("decimal(38,9)"), 6).cast("decimal(18,6)")))


def _known_zones() -> list[str]:
    from pyspark import SparkContext
    return sorted(SparkContext._active_spark_context._jvm.java.time.ZoneId.getAvailableZoneIds())


def _leaf_ok(x: Column, kind: str, name: str = "") -> tuple[Column, str]:
    """(is acceptable, what was expected) for a present leaf value.

    Casting the variant to double is null exactly for what is not a number,
    a boolean or numeric text, so most checks need no type name at all;
    inside the array lambdas (evaluated without code generation) every
    evaluation saved counts. The type name is read at most once per check.
    """
    t = _type(x)
    s = _get(x, to="string")
    d = _number(x)
    if kind == "str" and name == ZONE_FIELD:
        return (t == "STRING") & s.isin(_known_zones()), "a known time zone"
    if kind == "str":
        return t == "STRING", "a string"
    if kind == "float":
        # the text of a number matches the pattern as numeric text does
        return d.isNotNull() & s.rlike(NUMBER_TEXT), "a number"
    if kind == "int":
        lo, hi = INT_RANGES[S.leaf_type(name, "int").simpleString()]
        whole = d.isNotNull() & (d == F.floor(d)) & d.between(lo, hi)
        return whole & ((t != "STRING") | s.rlike(INT_TEXT)), "a whole number"
    if kind == "bool":
        words = list(TRUE_WORDS + FALSE_WORDS)
        return F.when(t == "STRING", F.lower(s).isin(words)).otherwise(d.isin(0.0, 1.0)), \
            "a boolean"
    if kind == "date":
        written = (t == "STRING") & s.rlike(DATE_TEXT) & F.substring(s, 1, 10).try_cast("date").isNotNull()
        return written | F.coalesce(_since_1970(x) % DAY_SECONDS == 0, F.lit(False)), "a date (YYYY-MM-DD)"
    if kind == "datetime":
        written = (t == "STRING") & s.rlike(NAIVE_DATETIME_TEXT) & F.upper(s).try_cast("timestamp_ntz").isNotNull()
        if name == LOCAL_FIELD:
            return written, "a local datetime without zone"
        aware = (t == "STRING") & s.rlike(AWARE_DATETIME_TEXT) & F.upper(s).try_cast("timestamp").isNotNull()
        return written | aware | _since_1970(x).isNotNull(), "a datetime"
    raise ValueError(kind)


def _msg(prefix: Column, text: str) -> Column:
    return F.concat(prefix, F.lit(text))


# ---------------------------------------------------------------------------
# Each top-level part is cast once to a struct whose leaves are variants
# (arrays of objects included), so checks and casts read struct fields
# instead of walking variant paths again and again; inside the array
# lambdas, which run without code generation, that matters most.
# ---------------------------------------------------------------------------

def shape_ddl(spec) -> str:
    """DDL of the struct-of-variants shape of ``spec``."""
    if isinstance(spec, dict):
        return "struct<" + ", ".join(f"`{k}`: {shape_ddl(v)}" for k, v in spec.items()) + ">"
    if isinstance(spec, list):
        return f"array<{shape_ddl(spec[0])}>"
    return "variant"


def _leaf_problem(x: Column, kind: str, prefix: Column, text: Column, name: str = "") -> Column:
    """Null, or the one problem of leaf variant ``x``, looked at only if its ``text`` is not accepted."""
    ok, expected = _leaf_ok(x, kind, name)
    out = F.when(_text_leaf_ok(text, kind, name), F.lit(None).cast("string")).when(_missing(x), _msg(prefix, ": missing"))
    if name == LOCAL_FIELD:
        aware = _numeric(_type(x)) | ((_type(x) == "STRING")
                                      & _get(x, to="string").rlike(AWARE_DATETIME_TEXT))
        out = out.when(aware, _msg(prefix, ": timezone-aware datetime"))
    return out.when(~ok, _msg(prefix, f": expected {expected}"))


def _shaped_violations(x: Column, spec, prefix: Column, raw: Column, texts: Column) -> Column:
    """array<string> problems of an already shaped value, whose texts are ``texts``.

    The shaping cast nulls exactly the nested object or list whose shape is
    wrong, like a missing one; only then is the raw variant ``raw`` looked
    at, to tell "missing" from "not an object"/"not a list".
    """
    wrong = ": not an object" if isinstance(spec, dict) else ": not a list"
    fallback = F.when(_missing(raw), F.array(_msg(prefix, ": missing"))) \
        .otherwise(F.array(_msg(prefix, wrong)))
    if isinstance(spec, dict):
        leaves = [_leaf_problem(x[k], sub, F.concat(prefix, F.lit(f".{k}")), texts[k], k)
                  for k, sub in spec.items() if not isinstance(sub, (dict, list))]
        nested = [_shaped_violations(x[k], sub, F.concat(prefix, F.lit(f".{k}")), _get(raw, f"$.{k}"), texts[k])
                  for k, sub in spec.items() if isinstance(sub, (dict, list))]
        own = F.array_compact(F.array(*leaves)) if leaves else F.array().cast("array<string>")
        return F.when(x.isNull(), fallback).otherwise(F.concat(own, *nested) if nested else own)
    if isinstance(spec, list):
        raw_items = _get(raw, to="array<variant>")
        per_item = F.transform(x, lambda e, i: _shaped_violations(
            e, spec[0], F.concat(prefix, F.lit("["), i.cast("string"), F.lit("]")),
            F.element_at(raw_items, i + 1), F.get(texts, i)))
        return F.when(x.isNull(), fallback).otherwise(F.flatten(per_item))
    raise ValueError(spec)


def _leaf_typed(x: Column, spec: str, name: str) -> Column:
    """The typed value of a leaf that passed ``_leaf_ok``."""
    if spec == "str":
        return _get(x, to="string")
    if spec == "float":
        return _number(x)
    if spec == "int":
        plain = F.replace(_get(x, to="string"), F.lit("_"), F.lit("")).try_cast("decimal(38,10)")
        return F.coalesce(_get(x, to="decimal(38,10)"), plain).cast(S.leaf_type(name, "int"))
    if spec == "bool":
        return F.when(_type(x) == "STRING", F.lower(_get(x, to="string")).isin(list(TRUE_WORDS))) \
            .otherwise(_get(x, to="double") != 0)
    if spec == "date":
        written = F.substring(_get(x, to="string"), 1, 10)
        return F.when(written.rlike(r"^\d{4}-\d{2}-\d{2}$"), written.try_cast("date")) \
            .otherwise(F.date_from_unix_date((_since_1970(x) / DAY_SECONDS).cast("int")))
    if spec == "datetime":
        s = F.upper(_get(x, to="string"))
        naive = F.when(s.rlike(NAIVE_DATETIME_TEXT), s.try_cast("timestamp_ntz"))
        if name == LOCAL_FIELD:
            return naive
        aware = F.when(s.rlike(AWARE_DATETIME_TEXT), F.unix_micros(s.try_cast("timestamp")) / 1e6)
        return F.coalesce(naive, _wall_clock(F.coalesce(aware, _since_1970(x))))
    raise ValueError(spec)


def _shaped_typed(x: Column, spec, name: str = "") -> Column:
    if isinstance(spec, dict):
        return F.struct(*[_shaped_typed(x[k], sub, k).alias(k) for k, sub in spec.items()])
    if isinstance(spec, list):
        return F.transform(x, lambda e: _shaped_typed(e, spec[0]))
    return _leaf_typed(x, spec, name)


# ---------------------------------------------------------------------------
# The same checks and casts on the text of a leaf: what they accept is valid
# whichever JSON type the text came from; all else is left to the checks above.
# ---------------------------------------------------------------------------

def text_ddl(spec) -> str:
    """DDL of the struct-of-texts shape of ``spec``."""
    return shape_ddl(spec).replace("variant", "string")


def _ungrouped(s: Column) -> Column:
    return F.replace(s, F.lit("_"), F.lit(""))


def _text_number(s: Column) -> Column:
    return F.coalesce(s.try_cast("double"), _ungrouped(s).try_cast("double"))


def _text_leaf_ok(s: Column, kind: str, name: str) -> Column:
    """Whether a leaf with this text is acceptable (null or false: not known from the text)."""
    if kind == "str" and name == ZONE_FIELD:
        return s.isin(_known_zones())
    if kind == "str":
        return ~s.rlike(MAYBE_NO_STRING)
    if kind == "float":
        return s.rlike(PLAIN_NUMBER) | (s.rlike(NUMBER_TEXT) & _text_number(s).isNotNull())
    if kind == "int":
        to = S.leaf_type(name, "int").simpleString()
        d = _text_number(s)
        return s.rlike(PLAIN_INT[to]) | (s.rlike(INT_TEXT) & (d == F.floor(d)) & d.between(*INT_RANGES[to]))
    if kind == "bool":
        return F.lower(s).isin(list(TRUE_WORDS + FALSE_WORDS))
    if kind == "date":
        return s.rlike(DATE_TEXT) & F.substring(s, 1, 10).try_cast("date").isNotNull()
    if kind == "datetime":
        return s.rlike(NAIVE_DATETIME_TEXT) & F.upper(s).try_cast("timestamp_ntz").isNotNull()
    raise ValueError(kind)


def _leaves(x: Column, spec: dict) -> list[tuple[Column, str, str]]:
    """(text, kind, field) of an object's leaves and those of the objects in it, but not of its lists."""
    out = []
    for k, sub in spec.items():
        if isinstance(sub, dict):
            out += _leaves(x[k], sub)
        elif not isinstance(sub, list):
            out.append((x[k], sub, k))
    return out


def _common_form(kind: str, name: str) -> str:
    if name == ZONE_FIELD:
        return r"[^\x01]*+"
    return COMMON[S.leaf_type(name, "int").simpleString() if kind == "int" else kind]


def _common_ok(x: Column, spec: dict) -> Column:
    """Whether all leaves of an object have a common form: one pattern over all of their texts."""
    leaves = _leaves(x, spec)
    joined = F.concat(*[c for s, _, _ in leaves for c in (s, F.lit(END))])
    ok = joined.rlike("^" + "".join(_common_form(kind, name) + END for _, kind, name in leaves) + r"\z")
    for s, _, name in leaves:
        if name == ZONE_FIELD:
            ok = ok & s.isin(_known_zones())
    return ok


def _lists(x: Column, spec: dict) -> list[tuple[Column, list]]:
    return [y for k, sub in spec.items() for y in (
        _lists(x[k], sub) if isinstance(sub, dict) else [(x[k], sub)] if isinstance(sub, list) else [])]


def _texts_ok(x: Column, spec) -> Column:
    """Whether all texts of a part are acceptable."""
    if isinstance(spec, list):
        return x.isNotNull() & F.forall(x, lambda e: _texts_ok(e, spec[0]))
    out = x.isNotNull()
    leaves = _leaves(x, spec)
    if leaves:
        each = F.lit(True)
        for s, kind, name in leaves:
            each = each & _text_leaf_ok(s, kind, name)
        out = out & F.when(_common_ok(x, spec), True).otherwise(each)
    for y, sub in _lists(x, spec):
        out = out & _texts_ok(y, sub)
    return out


def _text_leaf_typed(s: Column, kind: str, name: str) -> Column:
    """The typed value of a text that passed ``_text_leaf_ok``."""
    if kind == "str":
        return s
    if kind == "float":
        return _text_number(s)
    if kind == "int":
        to = S.leaf_type(name, "int")
        return F.coalesce(s.try_cast(to), _ungrouped(s).try_cast("decimal(38,10)").cast(to))
    if kind == "bool":
        return F.lower(s).isin(list(TRUE_WORDS))
    if kind == "date":
        return F.substring(s, 1, 10).try_cast("date")
    if kind == "datetime":
        return F.upper(s).try_cast("timestamp_ntz")
    raise ValueError(kind)


def _texts_typed(x: Column, spec, name: str = "") -> Column:
    if isinstance(spec, dict):
        return F.struct(*[_texts_typed(x[k], sub, k).alias(k) for k, sub in spec.items()])
    if isinstance(spec, list):
        return F.transform(x, lambda e: _texts_typed(e, spec[0]))
    return _text_leaf_typed(x, spec, name)


def _plain(name: str) -> Column:
    return F.col(PLAIN_PREFIX + name)


def _part(name: str) -> Column:
    return F.col(PART_PREFIX + name)


def _shaped(name: str) -> Column:
    return F.col(SHAPED_PREFIX + name)


def with_parts(df: DataFrame, record: str = "record") -> DataFrame:
    """Read the texts of a record's leaves once, and extract each top-level part that needs it, raw and shaped."""
    texts = _get(F.col(record), to=text_ddl(S.RECORD_SPEC))
    plain = _once("plain", lambda: {PLAIN_PREFIX + n: F.coalesce(_texts_ok(F.col(TEXTS)[n], sub), F.lit(False))
                                    for n, sub in S.RECORD_SPEC.items()})
    parts = {PART_PREFIX + n: F.when(~_plain(n), _get(F.col(record), f"$.{n}")) for n in S.RECORD_SPEC}
    shaped = {SHAPED_PREFIX + n: _get(F.col(PART_PREFIX + n), to=shape_ddl(sub))
              for n, sub in S.RECORD_SPEC.items()}
    return df.withColumn(TEXTS, texts).withColumns(plain).withColumns(parts).withColumns(shaped)


def _helper_columns() -> list[str]:
    return [TEXTS] + [p + n for n in S.RECORD_SPEC for p in (PLAIN_PREFIX, PART_PREFIX, SHAPED_PREFIX)]


_built: dict[tuple, Column | dict[str, Column]] = {}


def _once(key: str, build) -> Column:
    """Build a large expression once per Spark context and reuse it.

    The check and cast trees take thousands of calls from Python to build;
    as unresolved expressions they can serve any number of DataFrames.
    """
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    k = (key, sc.applicationId if sc is not None else None)
    if k not in _built:
        _built[k] = build()
    return _built[k]


def record_violations(record: Column) -> Column:
    """Problems of one record, e.g. ``["current.temp_c: missing"]``.

    Needs the columns of ``with_parts``.
    """
    none = F.array().cast("array<string>")
    parts = []
    all_plain = F.lit(True)
    for name, sub in S.RECORD_SPEC.items():
        raw, shaped, label = _part(name), _shaped(name), F.lit(name)
        parts.append(F.when(_plain(name), none).otherwise(_shaped_violations(shaped, sub, label, raw, F.col(TEXTS)[name])))
        all_plain = all_plain & _plain(name)
    return (F.when(all_plain, none)
            .when(_missing(record), F.array(F.lit("record: missing")))
            .when(~_is_object(record), F.array(F.lit("record: not an object")))
            .otherwise(F.concat(*parts)))


def typed_record() -> Column:
    """The valid record as ``struct<location, current, forecast>`` of typed fields.

    Needs the columns of ``with_parts``; only meaningful without violations.
    """
    return _once("typed", lambda: F.struct(*[
        F.when(_plain(k), _texts_typed(F.col(TEXTS)[k], sub)).otherwise(_shaped_typed(_shaped(k), sub, k)).alias(k)
        for k, sub in S.RECORD_SPEC.items()]))


def validate_records(records: DataFrame, keep_parts: bool = False) -> DataFrame:
    """Add ``violations``; documents that were not JSON objects get one too.

    ``keep_parts`` keeps the extracted part columns for ``typed_record``.
    """
    v = _once("violations", lambda: F.when(
        ~F.col("doc_ok"), F.array(F.lit("document: malformed JSON or not an object")))
        .otherwise(record_violations(F.col("record"))))
    out = with_parts(records).withColumn("violations", v)
    return out if keep_parts else drop_parts(out)


def drop_parts(df: DataFrame) -> DataFrame:
    return df.drop(*_helper_columns())


def fail_on_violation(checked: DataFrame) -> DataFrame:
    """Stop the job at the first invalid record, naming it and its problem."""
    bad = F.size("violations") > 0
    msg = F.concat(F.lit("invalid record "), F.coalesce(F.col("label"), F.lit("?")),
                   F.lit(" in "), F.col("source"), F.lit(": "),
                   F.array_join("violations", "; "))
    return checked.where(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True)))


def valid_only(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0)


def quarantined(checked: DataFrame) -> DataFrame:
    """Invalid records with their problems and their text."""
    return checked.where(F.size("violations") > 0).select(
        "source", "label", "violations", F.to_json("record").alias("record_json"))
