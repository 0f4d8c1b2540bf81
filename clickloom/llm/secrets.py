"""Secrets in texts, and weak candidates that become findings beside their complement.

Base kinds are found by pattern alone. Weak kinds (a random-looking value, an account name, an
address of a service) are common in clean text; one is reported only when the parts that make
it a credential lie in its scope, ``SCOPE`` code points of the same document before or after:

* ``value`` beside an identifier (``access`` or ``account``),
* ``account`` beside a secret (``assign``, ``hex`` or ``value``),
* ``endpoint`` beside both.

The link is an interval join: parts are added up by document, role and slot of ``SCOPE`` code
points, of which only the first and last start matter, and a candidate probes its own slot and
the two beside it. No pair of parts is ever listed. All of it is DataFrame functions.

Each row of the input is a scope of its own, repeated or not, and gives one row; a null text
counts as empty, a null ``doc_id`` stays null, extra columns are ignored. Text without a finding
has zero counts, the hash of the empty text and empty ``spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.storage import stored, unused

SCOPE = 256

# The patterns of the base kinds.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the same matches as [0-9a-f]+ of 16 characters and more
VALUE = r"[A-Za-z0-9+/=_-]{24,}"
ACCOUNT = r"(client|access|account|user|login)[_-]?(id|name|key_id|key)?[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
ENDPOINT = r"(https?|postgres|postgresql|mysql|mongodb|redis|amqp|s3|ftp|ssh)://[A-Za-z0-9_.:/@%-]+"

KINDS = ["assign", "access", "hex", "value", "account", "endpoint"]
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, VALUE, ACCOUNT, ENDPOINT), strict=True))
IDENTIFIER, SECRET = ("access", "account"), ("assign", "hex", "value")
NEEDS = {"value": (IDENTIFIER,), "account": (SECRET,), "endpoint": (IDENTIFIER, SECRET)}


def _accepted(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, f"^{ASSIGN}$", 2)) >= 12
    if kind == "access":
        return F.length(match) >= 18
    if kind == "value":
        return match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
    return F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    """Of each match of a kind: code points since the match before it, length, and whether it counts."""
    pattern = F.lit(PATTERNS[kind])
    between = F.split(text, PATTERNS[kind], -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.transform(
        F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match")),
        lambda p: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.length(p["gap"]).alias("gap"),
            F.length(p["match"]).alias("length"),
            _accepted(kind, p["match"]).alias("accepted"),
        ),
    )
    empty = F.array().cast("array<struct<kind:int,gap:int,length:int,accepted:boolean>>")
    return F.when(text.rlike(PATTERNS[kind]), parts).otherwise(empty)


def _index(kinds: tuple[str, ...]) -> list[int]:
    return [KINDS.index(k) for k in kinds]


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts (``row, kind, start, end``) whose complement lies within ``scope`` of their start."""
    slots = parts.withColumn("slot", F.expr(f"start div {scope}"))
    out = None
    for kind, roles in NEEDS.items():
        weak = parts.where(F.col("kind") == KINDS.index(kind))
        for role in roles:
            known = (
                slots.where(F.col("kind").isin(_index(role)))
                .groupBy("row", "slot")
                .agg(F.min("start").alias("first"), F.max("start").alias("last"))
            )
            probes = weak.withColumn("own", F.expr(f"start div {scope}")).withColumn(
                "slot", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1))
            )
            near = (
                ((F.col("slot") < F.col("own")) & (F.col("start") - F.col("last") <= scope))
                | (F.col("slot") == F.col("own"))
                | ((F.col("slot") > F.col("own")) & (F.col("first") - F.col("start") <= scope))
            )
            weak = probes.join(known, ["row", "slot"]).where(near).groupBy("row", "kind", "start", "end").agg(F.lit(1).alias("_one")).drop("_one")
        out = weak if out is None else out.unionByName(weak)
    return out


def scan_documents(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` and the array ``findings`` of each row.

    A finding has ``kind``, ``start`` and ``end`` (code points, end exclusive).
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").alias("doc_id"),
            F.concat(*(_matches(whole, k) for k in KINDS)).alias("parts"),
        )
    )
    of_kind = Window.partitionBy("row", "kind").orderBy("at")
    parts = (
        rows.select("row", F.posexplode("parts").alias("at", "part"))
        .select("row", "at", "part.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("length")).over(of_kind))
        .withColumn("start", F.col("end") - F.col("length"))
        .where("accepted")
        .select("row", "kind", "start", "end")
    )
    parts = stored(parts)
    base = parts.where(F.col("kind") < KINDS.index("value"))
    findings = base.unionByName(linked(parts, scope))
    finding = F.struct("start", "kind", "end")
    joined = rows.select("row", "doc_id", F.lit(None).cast("long").alias("start"), F.lit(None).cast("int").alias("kind"), F.lit(None).cast("long").alias("end")).unionByName(
        findings.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)).select("row", "doc_id", "start", "kind", "end")
    )
    grouped = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), finding))).alias("findings"),
    )
    names = F.array(*(F.lit(k) for k in KINDS))

    def listed(findings: Column) -> Column:
        return F.array_join(
            F.transform(findings, lambda f: F.concat_ws(":", F.element_at(names, f["kind"] + 1), f["start"].cast("string"), f["end"].cast("string"))), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == KINDS.index(kind))).cast("long")

    return grouped.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(listed(F.filter("findings", lambda f: f["kind"] < KINDS.index("value"))), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
        F.transform(
            "findings", lambda f: F.struct(F.element_at(names, f["kind"] + 1).alias("kind"), f["start"].alias("start"), f["end"].alias("end"))
        ).alias("findings"),
    )


def masked_documents(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """All rows, with each finding in the text replaced; findings that overlap become one mask."""
    whole = F.coalesce(F.col(text), F.lit(""))
    name, findings, merged = (unused(docs, c) for c in ("_name", "_findings", "_runs"))
    named = docs.withColumn(name, F.concat_ws(":", F.sha2(whole, 256), F.length(whole)))
    found = scan_documents(named.select(F.col(name).alias("doc_id"), whole.alias("text")).dropDuplicates(["doc_id"]))
    found = found.where(F.size("findings") > 0).select(F.col("doc_id").alias(name), F.col("findings").alias(findings))
    joined = named.join(found, name, "left")
    runs = F.aggregate(
        findings,
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda runs, f: F.when(
            (F.size(runs) > 0) & (F.element_at(runs, -1)["end"] >= f["start"]),
            F.concat(
                F.slice(runs, F.lit(1), F.size(runs) - 1),
                F.array(F.struct(F.element_at(runs, -1)["start"].alias("start"), F.greatest(F.element_at(runs, -1)["end"], f["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(runs, F.array(F.struct(f["start"].alias("start"), f["end"].alias("end"))))),
    )
    bounds = F.col(merged)
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(bounds)),
        lambda k: F.substring(
            F.col(text),
            (F.when(k == 0, F.lit(0)).otherwise(F.element_at(bounds, k)["end"]) + 1).cast("int"),
            (
                F.when(k == F.size(bounds), F.length(text)).otherwise(F.get(bounds, k)["start"])
                - F.when(k == 0, F.lit(0)).otherwise(F.element_at(bounds, k)["end"])
            ).cast("int"),
        ),
    )
    masked = F.when(F.col(findings).isNull(), F.col(text)).otherwise(F.array_join(pieces, mask))
    columns = [masked.alias(c) if c == text else F.col(c) for c in docs.columns]
    return joined.withColumn(merged, runs).select(*columns)


def _sql_matches(kind: str) -> str:
    pattern = PATTERNS[kind].replace("'", "''")
    accepted = {
        "assign": f"length(regexp_extract(m, '{pattern}', 2)) >= 12",
        "access": "length(m) >= 18",
        "value": "regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')",
    }.get(kind, "true")
    return (
        f"SELECT doc_id, {KINDS.index(kind)} AS kind, stop - length(m) AS b, stop AS e FROM ("
        f"SELECT doc_id, m, sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM ("
        f"SELECT doc_id, unnest(regexp_extract_all(t, '{pattern}', 0)) AS m, "
        f"unnest(list_slice(string_split_regex(t, '{pattern}'), 1, len(regexp_extract_all(t, '{pattern}', 0)))) AS g, "
        f"unnest(range(len(regexp_extract_all(t, '{pattern}', 0)))) AS i "
        f"FROM d WHERE regexp_matches(t, '{pattern}'))) WHERE {accepted}"
    )


def _sql_near(kinds: tuple[str, ...], weak: str) -> str:
    """By a list of starts of each document, not by the slots of the operator."""
    return (
        f"EXISTS (SELECT 1 FROM p c WHERE c.doc_id = {weak}.doc_id AND c.kind IN ({', '.join(map(str, _index(kinds)))}) "
        f"AND abs(c.b - {weak}.b) <= {SCOPE})"
    )


def _sql() -> str:
    names = "['" + "', '".join(KINDS) + "']"
    text = f"list_transform(l, lambda x: {names}[x.k + 1] || ':' || CAST(x.b AS VARCHAR) || ':' || CAST(x.e AS VARCHAR))"
    base = text.replace("list_transform(l,", "list_transform(list_filter(l, lambda y: y.k < 3),")
    weak = " OR ".join(
        f"(p.kind = {KINDS.index(kind)} AND " + " AND ".join(_sql_near(role, "p") for role in roles) + ")"
        for kind, roles in NEEDS.items()
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS ({' UNION ALL '.join(_sql_matches(k) for k in KINDS)}),
f AS (SELECT * FROM p WHERE kind < 3 OR {weak}),
g AS (SELECT doc_id, list(struct_pack(b := b, k := kind, e := e) ORDER BY b, kind) AS l FROM f GROUP BY doc_id),
a AS (SELECT d.doc_id, coalesce(g.l, []) AS l FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, len(list_filter(l, lambda x: x.k = 0)) AS n_assign, len(list_filter(l, lambda x: x.k = 1)) AS n_access,
       len(list_filter(l, lambda x: x.k = 2)) AS n_hex,
       sha256(coalesce(array_to_string({base}, ','), '')) AS base_sha256,
       coalesce(array_to_string({text}, ','), '') AS spans
FROM a"""


SQL = _sql()
