"""Contract validation of untrusted JSON events.

A contract is a list of fields with a kind, a default and checks, plus checks
over whole rows.  ``validate`` compiles it to column expressions: one pass, no
shuffle but the one look-up of referenced files.  The first failure in contract
order is the reason: fields as declared, then unknown fields, then row checks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, functions as F

from quire import fixed_values as fixed
from quire.functions import text as tx
from quire.session import materialize

# (failed?, code, message); a NULL condition counts as not failed.
Check = tuple[Column, str, Column]


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # string | integer | literal | uuid | timestamp
    required: bool = False
    nullable: bool = False
    choices: tuple[str, ...] = ()
    default: Callable[[Column], Column] | None = None  # run clock -> value
    stripped: bool = False
    checks: Callable[[Column], list[Check]] | None = None


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    # Columns derived from the values, and checks over values and derived columns.
    derived: Callable[[Callable[[str], Column]], dict[str, Column]] | None = None
    row_checks: Callable[[Callable[[str], Column]], list[Check]] | None = None
    path_field: str | None = None  # must name a file of the inventory

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _message(template: str, *args: Column | str) -> Column:
    return F.format_string(template, *[a if isinstance(a, Column) else F.lit(a) for a in args])


def _error(code: str, message: Column | str) -> Column:
    message = message if isinstance(message, Column) else F.lit(message)
    return F.struct(F.lit(code).alias("code"), message.alias("message"))


def _first_failure(checks: list[Check]) -> Column | None:
    if not checks:
        return None
    return F.coalesce(*[F.when(failed, _error(code, msg)) for failed, code, msg in checks])


# --- kinds -------------------------------------------------------------------
# A kind turns a raw JSON value into steps of helper columns, a normalized value
# and an error.  ``kind`` is the JSON kind as the engine names it, ``raw`` the
# value as text.  The usual spelling of a value is recognized first; what an
# error says is worked out only for values that have one.


@dataclass(frozen=True)
class Compiled:
    value: Column
    error: Column
    steps: tuple[dict[str, Column], ...] = ()


def _kind(field: Field) -> Column:
    return F.col(f"_kind_{field.name}")


def _raw(field: Field) -> Column:
    return F.col(f"_raw_{field.name}")


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))


def _string(field: Field) -> Compiled:
    kind, raw = _kind(field), _raw(field)
    wrong = (kind != "STRING") & (kind != "VOID") if field.nullable else kind != "STRING"
    value = F.when(kind == "STRING", tx.strip(raw) if field.stripped else raw)
    return Compiled(value, F.when(wrong, _error("string_type", fixed.MSG_STRING)))


def _literal(field: Field) -> Compiled:
    kind, raw = _kind(field), _raw(field)
    quoted = [f"'{c}'" for c in field.choices]
    allowed = " or ".join([", ".join(quoted[:-1]), quoted[-1]] if len(quoted) > 1 else quoted)
    wrong = (kind != "STRING") | ~raw.isin(*field.choices)
    return Compiled(raw, F.when(wrong, _error("literal_error", f"Input should be {allowed}")))


WHOLE_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*([.]0+)?$"


def _integer(field: Field) -> Compiled:
    """Whole numbers as digit text, so that any magnitude reaches the bounds."""
    kind, raw = _kind(field), _raw(field)
    number = raw.try_cast("double")
    bare = F.regexp_replace(tx.strip(raw), "^[+]|_|[.]0+$", "")
    from_text = F.when(
        tx.strip(raw).rlike(WHOLE_TEXT), F.regexp_replace(F.regexp_replace(bare, "^(-?)0+(?=[0-9])", "$1"), "^-0$", "0")
    )
    # Decimals without a fraction keep every digit; doubles have a whole part.
    from_number = F.when(raw.rlike("^-?[0-9]+$"), raw).when(
        number == F.floor(number), number.try_cast("bigint").cast("string")
    )
    value = (
        F.when(kind == "BIGINT", raw)
        .when(kind == "STRING", from_text)
        .when(kind == "BOOLEAN", F.when(raw == "true", "1").otherwise("0"))
        .when(_is_number(kind), from_number)
    )
    name = f"_{field.name}_digits"
    error = F.when(
        (kind != "BIGINT") & F.col(name).isNull(),
        F.when(kind == "STRING", _error("int_parsing", fixed.MSG_INT_TEXT))
        .when(~_is_number(kind), _error("int_type", fixed.MSG_INT))
        .when(F.abs(number) >= 2.0**63, _error("int_parsing_size", fixed.MSG_INT_SIZE))
        .otherwise(_error("int_from_float", fixed.MSG_INT_FRACTION)),
    )
    return Compiled(F.col(name), error, ({name: value},))


UUID_CANONICAL = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
UUID_PARTS = "([0-9a-fA-F]{8})-?([0-9a-fA-F]{4})-?([0-9a-fA-F]{4})-?([0-9a-fA-F]{4})-?([0-9a-fA-F]{12})"
UUID_HYPHENATED = UUID_PARTS.replace("-?", "-")
UUID_ACCEPTED = rf"^(?:(?:urn:uuid:)?{UUID_HYPHENATED}|\{{{UUID_HYPHENATED}\}}|[0-9a-fA-F]{{32}})$"
UUID_GROUPS = (8, 4, 4, 4, 12)


def _uuid(field: Field) -> Compiled:
    kind, raw = _kind(field), _raw(field)
    usual, accepted = f"_{field.name}_usual", f"_{field.name}_accepted"
    steps = (
        {usual: (kind == "STRING") & raw.rlike(UUID_CANONICAL)},
        {accepted: F.col(usual) | ((kind == "STRING") & raw.rlike(UUID_ACCEPTED))},
    )
    # The accepted forms differ in length: bare hex, urn:uuid:, braces, upper case.
    cuts, start = [], 1
    for length in UUID_GROUPS:
        cuts.append(F.substring(raw, start, length))
        start += length
    rewritten = F.lower(
        F.when(F.length(raw) == 32, F.concat_ws("-", *cuts))
        .when(F.length(raw) == 45, F.substring(raw, 10, 36))
        .when(F.length(raw) == 38, F.substring(raw, 2, 36))
        .otherwise(raw)
    )

    body = F.regexp_replace(F.regexp_replace(raw, "^urn:uuid:", ""), r"^\{(.*)\}$", "$1")
    groups = F.split(body, "-")
    simple = (raw == body) & (F.size(groups) == 1)
    leading_hex = F.regexp_extract(body, "^[0-9a-fA-F-]*", 0)
    position = F.length(leading_hex) + F.length(raw) - F.length(F.regexp_replace(raw, r"^(urn:uuid:|\{)", ""))
    found = F.substring(body, F.length(leading_hex) + 1, F.lit(1))
    detail = (
        F.when(kind != "STRING", _error("uuid_type", fixed.MSG_UUID_TYPE))
        .when(
            F.length(leading_hex) < F.length(body),
            _error("uuid_parsing", _message(fixed.MSG_UUID_CHARACTER, found, position)),
        )
        .when(simple, _error("uuid_parsing", _message(fixed.MSG_UUID_LENGTH, F.length(body))))
        .when(F.size(groups) != 5, _error("uuid_parsing", _message(fixed.MSG_UUID_GROUPS, F.size(groups))))
    )
    for i, expected in enumerate(UUID_GROUPS):
        length = F.length(F.get(groups, F.lit(i)))
        detail = detail.when(
            length != expected,
            _error("uuid_parsing", _message(fixed.MSG_UUID_GROUP_LENGTH, F.lit(i), F.lit(expected), length)),
        )
    return Compiled(
        F.when(F.col(usual), raw).when(F.col(accepted), rewritten), F.when(~F.col(accepted), detail), steps
    )


# What clients usually send; only the zero parts of it are written differently.
ISO_USUAL = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}T(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
    "(?:[.][0-9]{6})?(?:Z|[+-](?:[01][0-9]|2[0-3]):[0-5][0-9])$"
)
ISO_FORM = (
    r"^([0-9]{4})-([0-9]{2})-([0-9]{2})"
    r"(?:[Tt _]([01][0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9])(?:[.,]([0-9]{1,9}))?)?"
    "(?:([Zz])|([+−-])([01][0-9]|2[0-3]):?([0-5][0-9]))?)?$"
)
ISO_PARTS = "$1|$2|$3|$4|$5|$6|$7|$8|$9|$10|$11"
EPOCH_TEXT = r"^[+-]?[0-9]+([.][0-9]+)?$"
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def _timestamp(field: Field) -> Compiled:
    """ISO text or epoch seconds/milliseconds -> canonical ISO text."""
    kind, raw = _kind(field), _raw(field)
    name = lambda x: f"_{field.name}_{x}"
    parts, date, epoch = F.col(name("parts")), F.col(name("date")), F.col(name("epoch"))
    usual = F.col(name("usual"))
    is_iso = usual | F.coalesce(F.size(parts) == 11, F.lit(False))
    at = lambda i: F.get(parts, F.lit(i))
    number = raw.try_cast("double")
    is_epoch = _is_number(kind) | ((kind == "STRING") & ~is_iso & raw.rlike(EPOCH_TEXT))
    unusual_text = (kind == "STRING") & ~usual
    steps = (
        {name("usual"): (kind == "STRING") & raw.rlike(ISO_USUAL)},
        {name("parts"): F.when(unusual_text, F.split(F.regexp_replace(raw, ISO_FORM, ISO_PARTS), "[|]"))},
        {
            name("date"): F.when(is_iso, F.substring(raw, 1, 10).try_cast("date")),
            name("epoch"): F.when(is_epoch, F.when(F.abs(number) > 2e10, number / 1000).otherwise(number)),
        },
    )

    or_zero = lambda i: F.when(at(i) == "", "00").otherwise(at(i))
    fraction = F.substring(F.rpad(at(6), 6, "0"), 1, 6)
    zone = (
        F.when(at(7) != "", "Z")
        .when(at(9) == "", "")
        .when((at(9) == "00") & (at(10) == "00"), "Z")
        .otherwise(F.concat(F.when(at(8) == "−", "-").otherwise(at(8)), at(9), F.lit(":"), at(10)))
    )
    iso = F.concat(
        F.substring(raw, 1, 10), F.lit("T"), F.concat_ws(":", or_zero(3), or_zero(4), or_zero(5)),
        F.when((at(6) != "") & (fraction != "000000"), F.concat(F.lit("."), fraction)).otherwise(""), zone,
    )
    shortened = F.replace(raw, F.lit(".000000"), F.lit(""))
    for zero in ("+00:00", "-00:00"):
        shortened = F.replace(shortened, F.lit(zero), F.lit("Z"))
    in_range = (epoch >= FIRST_SECOND) & (epoch < LAST_SECOND + 1)
    micros = F.round(F.when(in_range, epoch) * 1000000).cast("bigint")
    moment = F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    below = F.pmod(micros, F.lit(1000000))
    from_epoch = F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(below != 0, F.format_string(".%06d", below)).otherwise(""),
        F.lit("Z"),
    )

    month = F.regexp_extract(raw, "^[0-9]{4}-([0-9]{2})-[0-9]{2}", 1)
    parsing = lambda message: _error("datetime_parsing", message)
    detail = (
        F.when(epoch.isNotNull(), F.when(~in_range, parsing(fixed.MSG_DATETIME_RANGE)))
        .when(kind != "STRING", _error("datetime_type", fixed.MSG_DATETIME_TYPE))
        .when(F.length(raw) < 10, parsing(fixed.MSG_DATETIME_SHORT))
        .when((month != "") & ~month.between("01", "12"), parsing(fixed.MSG_DATETIME_MONTH))
        .when(is_iso & F.startswith(raw, F.lit("0000")), parsing(fixed.MSG_DATETIME_YEAR))
        .when((month != "") & F.substring(raw, 1, 10).try_cast("date").isNull(), parsing(fixed.MSG_DATETIME_DAY))
        .when(~is_iso, parsing(fixed.MSG_DATETIME_EXTRA))
    )
    # Year 0000 is a date to the engine, but not to the contract.
    fine = date.isNotNull() & ~F.startswith(raw, F.lit("0000"))
    return Compiled(
        F.when(fine, F.when(usual, shortened).otherwise(iso)).when(epoch.isNotNull(), from_epoch), F.when(F.coalesce(~fine, F.lit(True)), detail), steps
    )


KINDS = {"string": _string, "literal": _literal, "integer": _integer, "uuid": _uuid, "timestamp": _timestamp}


# --- validation ------------------------------------------------------------


def _normalized(path: Column) -> Column:
    """A plain path without repeated slashes, ``/./`` and a slash at its end.

    URIs stay as they are: in an object store such names are different objects.
    """
    single = F.regexp_replace(F.regexp_replace(path, "/(?:[.]?/)+", "/"), "(?<=[^/])/$", "")
    return F.when(F.contains(path, F.lit("://")), path).otherwise(single)


def file_paths(inventory: DataFrame) -> DataFrame:
    """The inventory's distinct paths, stored once for any number of look-ups.

    The join then sees a plain table: AQE splits the events of a path that many
    of them name.
    """
    return materialize(inventory.select(_normalized(F.col("path")).alias("_path")).distinct(), "paths")


def validate(
    df: DataFrame,
    contract: Contract,
    inventory: DataFrame | None = None,
    value_col: str = "value",
    now: Column | None = None,
    check_files: bool = True,
) -> DataFrame:
    """Add ``reason_code``, ``reason`` (NULL = accepted) and the struct ``event``.

    ``inventory`` has one row per existing file in column ``path``, or is the
    result of ``file_paths``.  A contract that names files needs one, unless
    ``check_files=False`` leaves that rule out.  Defaults such as a generated id are not repeatable: write the result once (see
    ``quire.streaming.ingest``) before reading it twice.
    """
    now = F.current_timestamp() if now is None else now
    look_up = contract.path_field is not None and check_files
    if look_up and inventory is None:
        raise ValueError("the contract checks files: pass an inventory, or check_files=False")
    kept = df.columns

    out = df.withColumn("_v", F.try_parse_json(value_col))
    out = out.withColumns(
        {
            "_malformed": F.col("_v").isNull(),
            "_keys": F.map_keys(F.try_variant_get("_v", "$", "map<string,variant>")),
            **{f"_kind_{f.name}": F.schema_of_variant(F.variant_get("_v", f"$.{f.name}", "variant")) for f in contract.fields},
            **{f"_raw_{f.name}": F.try_variant_get("_v", f"$.{f.name}", "string") for f in contract.fields},
        }
    )

    # The parsed value is not carried further than it is needed.
    unknown = F.size(F.array_except("_keys", F.array(*[F.lit(n) for n in contract.names]))) > 0
    out = out.withColumns({"_no_object": F.col("_keys").isNull(), "_unknown": unknown}).drop("_v", "_keys")

    compiled = {f: KINDS[f.kind](f) for f in contract.fields}
    for step in zip_longest(*[c.steps for c in compiled.values()], fillvalue={}):
        out = out.withColumns({name: column for helpers in step for name, column in helpers.items()})

    values, errors = {}, {}
    for f, made in compiled.items():
        present = _kind(f).isNotNull()
        default = f.default(now) if f.default else F.lit(None).cast("string")
        values[f"_val_{f.name}"] = F.when(present, made.value).otherwise(default)
        absent = _error("missing", fixed.MSG_MISSING) if f.required else F.lit(None)
        errors[f"_err_{f.name}"] = F.when(present, made.error).otherwise(absent)
    out = out.withColumns({**values, **errors})

    val = lambda name: F.col(f"_val_{name}")
    if contract.derived:
        out = out.withColumns({f"_val_{name}": column for name, column in contract.derived(val).items()})
    found = []
    for f in contract.fields:
        found.append(F.col(f"_err_{f.name}"))
        if f.checks:
            # A field's own checks see only values of the right type.
            found.append(F.when(F.col(f"_err_{f.name}").isNull(), _first_failure(f.checks(val(f.name)))))
    found.append(F.when(F.col("_unknown"), _error("extra_forbidden", fixed.MSG_EXTRA)))
    if contract.row_checks:
        found.append(_first_failure(contract.row_checks(val)))
    failure = (
        F.when(F.col("_malformed"), _error("malformed_json", "Input should be valid JSON"))
        .when(F.col("_no_object"), _error("not_an_object", "Input should be a valid dictionary"))
        .otherwise(F.coalesce(*found))
    )
    out = out.withColumn("_failure", failure)

    if look_up:
        path = val(contract.path_field)
        files = inventory if "_path" in inventory.columns else file_paths(inventory)
        files = files.withColumn("_exists", F.lit(True))
        # Only events that passed so far need the look-up; the others get keys
        # that match nothing and spread over all partitions.
        nowhere = F.concat(F.lit("\0"), F.xxhash64(value_col).cast("string"))
        out = out.withColumn("_lookup", F.when(F.col("_failure").isNull(), _normalized(path)).otherwise(nowhere))
        out = out.join(files, F.col("_lookup") == F.col("_path"), "left")
        missing = F.col("_failure").isNull() & F.col("_exists").isNull()
        out = out.withColumn(
            "_failure",
            F.when(missing, _error("file_missing", _message(fixed.MSG_FILE_MISSING, path))).otherwise(F.col("_failure")),
        )

    event = F.struct(
        *[(val(f.name).try_cast("bigint") if f.kind == "integer" else val(f.name)).alias(f.name) for f in contract.fields]
    )
    return out.select(
        *kept,
        F.col("_failure.code").alias("reason_code"),
        F.col("_failure.message").alias("reason"),
        F.when(F.col("_failure").isNull(), event).alias("event"),
    )


def accepted(validated: DataFrame) -> DataFrame:
    """The normalized events that passed, one column per contract field."""
    return validated.filter("reason_code IS NULL").select("event.*")


def rejected(validated: DataFrame, value_col: str = "value", now: Column | None = None) -> DataFrame:
    """What failed: the event as it came, why, and when."""
    now = F.current_timestamp() if now is None else now
    return validated.filter("reason_code IS NOT NULL").select(
        F.col(value_col).alias("original_event"),
        F.col("reason").alias("rejection_reason"),
        "reason_code",
        now.alias("rejected_at"),
    )


def route(validated: DataFrame, value_col: str = "value", now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    return accepted(validated), rejected(validated, value_col, now)


def ingestion_counts(validated: DataFrame) -> DataFrame:
    """One row: total, accepted, rejected."""
    return validated.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("reason_code").isNull()).alias("accepted"),
        F.count_if(F.col("reason_code").isNotNull()).alias("rejected"),
    )


def ingestion_verdict(validated: DataFrame, min_accepted: int = fixed.MIN_ACCEPTED) -> DataFrame:
    """One row: enough accepted events to go on?"""
    counts = ingestion_counts(validated)
    return counts.select("accepted", "rejected", (F.col("accepted") >= min_accepted).alias("passed"))


def rejection_breakdown(validated: DataFrame) -> DataFrame:
    """How often each reason occurred, most common first."""
    return (
        validated.filter("reason_code IS NOT NULL")
        .groupBy(tx.reason_key(F.col("reason")).alias("reason_key"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "reason_key")
    )


# --- the document contract ---------------------------------------------------


def _bare_name(name: Column) -> list[Check]:
    return [
        (name == "", "blank", F.lit(fixed.MSG_BLANK % "file_name")),
        (name.rlike(r"[/\\]|[.][.]"), "not_bare", _message(fixed.MSG_NOT_BARE, "file_name", name)),
    ]


def _uploader(name: Column) -> list[Check]:
    return [(name == "", "blank", F.lit(fixed.MSG_BLANK % "uploaded_by"))]


def _size(digits: Column) -> list[Check]:
    number = digits.try_cast("bigint")  # NULL for magnitudes beyond it
    negative = F.startswith(digits, F.lit("-"))
    return [
        (F.coalesce(number <= 0, negative), "empty_upload", _message(fixed.MSG_EMPTY_UPLOAD, digits)),
        (
            F.coalesce(number > fixed.MAX_FILE_SIZE_BYTES, ~negative),
            "oversized",
            _message(fixed.MSG_OVERSIZED, digits, F.lit(fixed.MAX_FILE_SIZE_BYTES)),
        ),
    ]


def _suffix_columns(val: Callable[[str], Column]) -> dict[str, Column]:
    return {"suffix": tx.file_suffix(val("file_name"))}


def _suffix_agrees(val: Callable[[str], Column]) -> list[Check]:
    suffix = val("suffix")
    expected = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in fixed.SUFFIX_TO_TYPE.items() for x in pair]), suffix
    )
    supported = "[" + ", ".join(f"'{s}'" for s in sorted(fixed.SUFFIX_TO_TYPE)) + "]"
    return [
        (
            expected.isNull(),
            "suffix_unsupported",
            _message(fixed.MSG_SUFFIX_UNSUPPORTED, val("file_name"), suffix, supported),
        ),
        (
            expected != val("file_type"),
            "suffix_mismatch",
            _message(fixed.MSG_SUFFIX_MISMATCH, val("file_type"), suffix, expected),
        ),
    ]


DOCUMENT_CONTRACT = Contract(
    fields=(
        Field("document_id", "uuid", default=lambda now: F.expr("uuid()")),
        Field("file_name", "string", required=True, stripped=True, checks=_bare_name),
        Field("file_path", "string", required=True),
        Field("file_type", "literal", required=True, choices=tuple(fixed.DOCUMENT_TYPES)),
        Field("file_size_bytes", "integer", required=True, checks=_size),
        Field(
            "category", "literal", choices=tuple(fixed.CATEGORIES),
            default=lambda now: F.lit(fixed.DEFAULT_CATEGORY),
        ),
        Field("course_code", "string", nullable=True),
        Field("uploaded_by", "string", required=True, stripped=True, checks=_uploader),
        Field("upload_timestamp", "timestamp", default=lambda now: F.regexp_replace(tx.iso_utc(now), "[+]00:00$", "Z")),
    ),
    derived=_suffix_columns,
    row_checks=_suffix_agrees,
    path_field="file_path",
)
