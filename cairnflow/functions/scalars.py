"""Scalar rules as Spark columns: everything here stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairnflow.model import BACKOFF_BASE_S, BACKOFF_CAP_S, EDGES, State


def normalized_name(name: Column) -> Column:
    """Runs of - _ . become one -, letters are lowered."""
    return F.lower(F.regexp_replace(name, "[-_.]+", "-"))


def percent_encoded(value: Column) -> Column:
    """Every UTF-8 byte outside the unreserved set as %XX."""
    out = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(out, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def metadata_url(url: Column) -> Column:
    return F.concat(url, F.lit(".metadata"))


def digest_matches(body: Column, expected: Column) -> Column:
    """True where nothing was expected or the body's SHA-256 is the expected one."""
    return expected.isNull() | (F.sha2(body, 256) == F.lower(expected))


def hex_to_raw(digest: Column) -> Column:
    return F.unhex(digest)


def raw_to_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def metadata_digest(core: Column, dist: Column) -> Column:
    """From the two JSON fields of a remote file: the sha256 of an object (the first field before the second), '' where
    metadata is there without a digest, null where there is none."""

    def own(field: Column) -> Column:
        return F.when(F.trim(field).startswith("{"), F.coalesce(F.get_json_object(field, "$.sha256"), F.lit("")))

    bare = (F.trim(core) == "true") | (F.trim(dist) == "true")
    return F.coalesce(own(core), own(dist), F.when(bare, F.lit("")))


def yanked_flag(value: Column) -> Column:
    """JSON true or any string means yanked."""
    return F.coalesce((F.trim(value) == "true") | F.trim(value).startswith('"'), F.lit(False))


def yanked_reason(value: Column) -> Column:
    """The string without its quotes; an empty one is none."""
    return F.when(F.trim(value).startswith('"'), F.nullif(F.regexp_replace(F.trim(value), '^"|"$', ""), F.lit("")))


def retry_after_seconds(value: Column, now: Column) -> Column:
    """Seconds from a number or an HTTP date, never negative; null where it is neither."""
    number = value.try_cast("double")
    date = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(value, "^[A-Za-z]{3}, ", ""), " GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    seconds = F.coalesce(number, (F.unix_micros(date) - F.unix_micros(now)) / 1e6)
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))


def http_class(status: Column, body: Column) -> Column:
    return (
        F.when((status == 304) | status.between(200, 299), "ok")
        .when(status.isin(404, 410), "not_found")
        .when((status == 429) | ((status == 403) & F.lower(F.coalesce(body, F.lit(""))).contains("rate limit")), "rate_limited")
        .when(status.between(500, 599), "transient")
        .otherwise("protocol")
    )


def utf8_text(body: Column) -> Column:
    """The text of the bytes without a leading byte order mark; null where they are not UTF-8."""
    return F.regexp_replace(F.try_validate_utf8(body.cast("string")), "^﻿", "")


def backoff_seconds(attempts: Column, base: float = BACKOFF_BASE_S, cap: float = BACKOFF_CAP_S) -> Column:
    """Without jitter: base doubled with each attempt after the first, up to the cap."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempts - 1), F.lit(cap))


def jittered(seconds: Column, seed: int | None = None) -> Column:
    return seconds * (F.lit(0.5) + F.rand(seed))


def human_bytes(n: Column) -> Column:
    """One decimal above bytes: 1.5 KB."""
    value, out = n.cast("double"), None
    for power, unit in enumerate(["B", "KB", "MB", "GB", "TB", "PB"]):
        scaled = value / float(1024**power)
        text = F.concat(n.cast("string"), F.lit(" B")) if power == 0 else F.format_string(f"%.1f {unit}", F.bround(scaled, 1))
        fits = scaled < 1024 if unit != "PB" else F.lit(True)
        out = F.when(fits, text) if out is None else out.when(fits, text)
    return out


def human_duration(seconds: Column) -> Column:
    """45s, 3m12s, 1h14m."""
    s = F.floor(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit("m"), two(s % 60), F.lit("s")))
        .otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit("h"), two(F.floor(s / 60) % 60), F.lit("m")))
    )


def label_escaped(value: Column) -> Column:
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def breaker_code(state: Column) -> Column:
    return F.when(state == "closed", 0).when(state == "half_open", 1).when(state == "open", 2)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def segment_name(segment_id: Column) -> Column:
    return F.format_string("%06d.zst", segment_id)


def segment_number(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\d{6,})\.zst$", 1).try_cast("long")


def squeezed(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def edge_allowed(before: Column, after: Column) -> Column:
    return F.struct(before.cast("int").alias("a"), after.cast("int").alias("b")).isin(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in EDGES])


def first_state(has_metadata: Column, unlinked_blob: Column) -> Column:
    """The state of a new artifact: a blob that waits for it, else metadata to fetch, else none."""
    return F.when(unlinked_blob.isNotNull(), int(State.NEED_CONVERT)).when(has_metadata, int(State.NEED_METADATA)).otherwise(int(State.NO_METADATA))


def lag(remote: Column, local: Column) -> Column:
    return F.when(remote.isNull(), F.lit(0).cast("long")).otherwise(F.greatest(F.lit(0).cast("long"), remote - F.coalesce(local, F.lit(0))))
