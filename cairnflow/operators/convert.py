"""Record conversion: an injected parser behind a fixed outcome contract."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConversionError(Exception):
    """What the parser cannot convert for good: the row is skipped until a newer version."""


class PrereleaseNeeded(ConversionError):
    """It could convert if pre-releases were allowed: one more attempt."""


def parse_headers(text: str) -> dict[str, list[str]]:
    """The default parser: header lines up to the first empty one; a line that starts with a blank continues."""
    out: dict[str, list[str]] = {}
    last = None
    for line in text.splitlines():
        if not line.strip():
            break
        if line[0] in " \t" and last:
            out[last][-1] += " " + line.strip()
            continue
        name, sep, value = line.partition(":")
        if not sep:
            raise ConversionError(f"not a header: {line[:40]!r}")
        last = name.strip().lower()
        out.setdefault(last, []).append(value.strip())
    if not out.get("name"):
        raise ConversionError("no name")
    return out


def header_records(parsed: dict[str, list[str]], filename: str, allow_pre: bool) -> list[dict]:
    """The default converter: one noarch record."""
    version = (parsed.get("version") or ["0"])[0]
    if not allow_pre and any(c.isalpha() for c in version):
        raise PrereleaseNeeded(version)
    name = parsed["name"][0].lower().replace("_", "-")
    needs = sorted(d.split(";")[0].strip() for d in parsed.get("requires-dist", []))
    return [{"name": name, "version": version, "build": "0", "build_number": 0, "subdir": "noarch", "fn": filename, "noarch": "generic", "depends": needs, "name_resolutions": [{"source_name": parsed["name"][0], "target_name": name}]}]


def convert_one(body: bytes | None, filename: str, version: str, parse: Callable, records: Callable) -> dict[str, Any]:
    """The outcome of one body: kind ok, skip or retry.

    Not UTF-8: a permanent skip without a version. A runtime error of the parser or converter: retry. Another error of
    theirs: a skip of this version. A converter that needs pre-releases has a second attempt; if that fails as well
    the first error is told. No records, or records of more than one name: retry."""

    def out(kind: str, reason: str = "", details: str = "", permanent: bool = False, pre: bool = False, rows: list | None = None) -> dict:
        return {"kind": kind, "reason": reason, "details": details, "permanent": permanent, "version": None if permanent else version, "requires_prerelease": pre, "records": rows or []}

    try:
        text = (body or b"").decode("utf-8-sig")
    except UnicodeDecodeError as e:
        return out("skip", "invalid_metadata_encoding", str(e), permanent=True)
    try:
        parsed = parse(text)
    except ConversionError as e:
        return out("skip", "invalid_metadata", f"{type(e).__name__}: {e}")
    except Exception as e:
        return out("retry", "parse_runtime_error", f"{type(e).__name__}: {e}")
    first: ConversionError | None = None
    for allow in (False, True):
        try:
            rows = records(parsed, filename, allow)
        except PrereleaseNeeded as e:
            if first is not None:
                return out("skip", "conversion_failed", f"{type(first).__name__}: {first}")
            first = e
        except ConversionError as e:
            told = first or e
            return out("skip", "conversion_failed", f"{type(told).__name__}: {told}")
        except Exception as e:
            return out("retry", "conversion_runtime_error", f"{type(e).__name__}: {e}")
        else:
            if not rows:
                return out("retry", "no_records_returned")
            if len({r["name"] for r in rows}) > 1:
                return out("retry", "name_disagreement", ", ".join(sorted({r["name"] for r in rows})))
            return out("ok", pre=allow, rows=rows)
    return out("skip", "conversion_failed", f"{type(first).__name__}: {first}")


RECORD = pa.struct([("name", pa.string()), ("version", pa.string()), ("build", pa.string()), ("build_number", pa.int32()), ("subdir", pa.string()), ("fn", pa.string()), ("noarch", pa.string()), ("depends", pa.list_(pa.string())), ("name_resolutions", pa.list_(pa.struct([("source_name", pa.string()), ("target_name", pa.string())])))])
RECORD_SQL = "array<struct<name:string,version:string,build:string,build_number:int,subdir:string,fn:string,noarch:string,depends:array<string>,name_resolutions:array<struct<source_name:string,target_name:string>>>>"


def convert(rows: DataFrame, version: str, parse: Callable = parse_headers, records: Callable = header_records) -> DataFrame:
    """id, kind, reason, details, permanent, version, requires_prerelease, records of rows(id, filename, body)."""
    names = ["kind", "reason", "details", "permanent", "version", "requires_prerelease"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [convert_one(b, f, version, parse, records) for f, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([d[n] for d in done], k) for n, k in zip(names, kinds, strict=True)), pa.array([d["records"] for d in done], pa.list_(RECORD))], names=["id", *names, "records"])

    return rows.select(F.col("id").cast("long"), "filename", F.col("body").cast("binary")).mapInArrow(run, f"id long, kind string, reason string, details string, permanent boolean, version string, requires_prerelease boolean, records {RECORD_SQL}")


def fan_out(converted: DataFrame) -> DataFrame:
    """One row for each record of the converted ones."""
    return converted.where("kind = 'ok'").select("id", F.explode("records").alias("r")).select("id", "r.*")


def first_resolutions(resolutions: Column) -> Column:
    """One resolution for each source name, the first, in the order of names."""
    names = F.array_sort(F.array_distinct(F.transform(resolutions, lambda r: r["source_name"])))
    return F.transform(names, lambda n: F.filter(resolutions, lambda r: r["source_name"] == n)[0])


def fetch_outcome(status_class: Column, digest_ok: Column) -> Column:
    """kind of a download: what is not there or has another digest is tried again, a throttled one costs no attempt."""
    return F.when(status_class == "rate_limited", "rate_limited").when((status_class == "ok") & digest_ok, "ok").otherwise("retry")
