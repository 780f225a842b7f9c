"""Secrets in texts: patterned credentials, and weak parts linked by an interval join.

Base kinds stand on their own: assignments, access identifiers, long hex strings.  Weak parts (user
names, short or unnamed secrets, endpoints) are common in harmless text; one is reported only when
the complementary parts of a credential lie in its scope, ``scope`` characters to either side:

* an identifier needs a secret, * a weak secret needs an identifier or an endpoint,
* an endpoint needs both an identifier and a secret.

The scope join is an interval join on buckets of ``scope`` characters.  Each bucket holds, per
role, the smallest start and the largest end of the parts that touch it; these decide exactly
whether some part meets a scope, so no pairs of parts are formed.  Only SQL functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygate.llm.common import text_or_empty, written

_FIRST = -(1 << 63)

# The base kinds' patterns; group 2 (or 0) must have the stated length.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

_VALUE = r"[\"']?\x20*[:=]\x20*[\"']?"
IDENT = (r"(?i:user|user_?name|login|account|account_?id|client_?id|access_?key|access_?key_?id)"
         + _VALUE + r"[A-Za-z0-9_.@+-]{3,}")
WEAK = (r"(?i:pwd|pass|pass_?phrase|auth|credential|private_?key|bearer)"
        + _VALUE + r"[A-Za-z0-9+/_.=!@#$%^&*-]{4,}")
ENDPOINT = (r"(?:(?i:https?|ftp|sftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp)://"
            r"[A-Za-z0-9_.:@/?&=%+-]+|(?i:host|host_?name|endpoint|server)" + _VALUE
            + r"[A-Za-z0-9_.:-]{3,})")

#: kind, pattern, group that must be long enough, its least length; in the order of the kinds.
KINDS = (
    ("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24),
    ("ident", IDENT, 0, 1), ("weak", WEAK, 0, 1), ("endpoint", ENDPOINT, 0, 1),
)
BASE = ("assign", "access", "hex")
_ROLE = {"assign": "secret", "hex": "secret", "weak": "secret", "access": "ident",
         "ident": "ident", "endpoint": "endpoint"}


@dataclass(frozen=True)
class Scope:
    scope: int = 256


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    ).withColumns({"_d": F.coalesce("doc_id", F.lit(_FIRST)), "_h": F.xxhash64("text")})


def _pieces(kind: int, pattern: str, group: int, least: int) -> Column:
    """Matches of one kind with the length of the text before each since the last match."""
    p = F.lit(pattern)
    whole = F.regexp_extract_all("text", p, F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all("text", p, F.lit(group))
    gaps = F.split("text", pattern, -1)
    return F.transform(
        F.arrays_zip(whole.alias("m"), value.alias("v"), F.slice(gaps, 1, F.size(whole)).alias("g")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("size"), (F.length(x["v"]) >= least).alias("ok")),
    )


def found_parts(docs: DataFrame) -> DataFrame:
    """(_d, _h, kind, start, end) of every match, kinds as numbers, weak ones included."""
    every = "|".join(f"(?:{p})" for _, p, _, _ in KINDS)
    rows = _keyed(docs).where(F.col("text").rlike(every)).select(
        "_d", "_h", F.concat(*[_pieces(k, p, g, n) for k, (_, p, g, n) in enumerate(KINDS)])
        .alias("parts"),
    ).dropDuplicates(["_d", "_h"])
    parts = rows.select("_d", "_h", F.inline("parts"))
    upto = Window.partitionBy("_d", "_h", "kind").orderBy("i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    return parts.select("_d", "_h", "kind", "size", "ok", end.alias("end")).where("ok").select(
        "_d", "_h", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(parts: DataFrame, how: Scope) -> DataFrame:
    """Base parts, and weak parts whose complementary parts lie in their scope."""
    number = {name: k for k, (name, *_) in enumerate(KINDS)}
    width = how.scope

    def role(name: str) -> Column:
        return F.col("kind").isin([number[k] for k, r in _ROLE.items() if r == name])

    touched = F.sequence(F.floor(F.col("start") / width),
                         F.floor((F.col("end") - 1) / width))
    roles = ("ident", "secret", "endpoint")
    buckets = parts.select("*", F.explode(touched).alias("bucket")).groupBy(
        "_d", "_h", "bucket"
    ).agg(*[f(F.when(role(r), F.col(c))).alias(f"{r}_{c}")
            for r in roles for f, c in ((F.min, "start"), (F.max, "end"))])
    weak = parts.where(F.col("kind") >= len(BASE)).withColumns(
        {"lo": F.col("start") - width, "hi": F.col("end") + width})
    # a part that ends right at ``lo`` is in the bucket of its last character, one before
    probes = weak.select("*", F.explode(F.sequence(
        F.floor((F.col("lo") - 1) / width), F.floor(F.col("hi") / width))).alias("bucket"))
    near = probes.join(buckets, ["_d", "_h", "bucket"]).groupBy(
        "_d", "_h", "kind", "start", "end"
    ).agg(*[F.coalesce(F.bool_or((F.col(f"{r}_start") <= F.col("hi"))
                                 & (F.col(f"{r}_end") >= F.col("lo"))), F.lit(False)).alias(r)
            for r in roles])
    whole = (
        ((F.col("kind") == number["ident"]) & F.col("secret"))
        | ((F.col("kind") == number["weak"]) & (F.col("ident") | F.col("endpoint")))
        | ((F.col("kind") == number["endpoint"]) & F.col("ident") & F.col("secret"))
    )
    columns = ("_d", "_h", "kind", "start", "end")
    return parts.where(F.col("kind") < len(BASE)).select(*columns).union(
        near.where(whole).select(*columns))


def scan(docs: DataFrame, how: Scope = Scope()) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end in order).

    Positions are code points, ends exclusive.  Runs a job.  Defined results: a null or empty text
    has no spans; rows equal in doc_id and text each get the same spans; spans of different kinds
    may overlap; an empty table gives an empty result; other columns are ignored.
    """
    parts = written(found_parts(docs), "parts")
    names = F.array(*[F.lit(name) for name, *_ in KINDS])
    spans = linked(parts, how).groupBy("_d", "_h").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return _keyed(docs).select("doc_id", "_d", "_h").join(spans, ["_d", "_h"], "left").select(
        "doc_id",
        F.transform(F.coalesce("spans", empty), lambda s: F.struct(
            F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"),
            s["end"].alias("end"))).alias("spans"))


def digests(scanned: DataFrame) -> DataFrame:
    """The counts, the digest of the base spans and the list of all spans, as the query returns."""
    def text(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def kind(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scanned.select(
        "doc_id", *[kind(k) for k in BASE],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"))
