"""Secrets in texts, with weak candidates confirmed by the parts they belong to. Built-in
functions alone.

Base kinds are strong enough by themselves: assigned secrets, access identifiers, long
hexadecimal strings. A credential often comes in parts, though, and a part alone proves
nothing: a user name, a short password, a random-looking token, the address of a service. Such
weak candidates are linked by an interval join. A scope is a block of text without an empty
line; two parts belong together if they stand in one scope with at most `REACH` code points
between them. Reported are

* a weak secret or token with an identifier (weak, or an access identifier) in reach,
* a weak identifier with a secret (weak, token or any base one) in reach,
* an endpoint with both in reach, or one that carries a name and a password itself.

Weak candidates that overlap a base span are part of it and not looked at again; so are tokens
and e-mail addresses inside any other weak candidate.

The join is a sweep, so parts are never paired: sorted by scope and start, every part sees the
nearest end of each role before it and the nearest start of each role after it, which is all
that reach asks for. Texts are read once and never shuffled. What matches is cut out of a text
twice, as what matched and as what lies between, from whose lengths and empty lines positions
and scopes follow by running sums, in time proportional to the number of matches. Only
texts with a base match, or with the parts of a credential, send their (narrow) parts on.

A null or empty text has no parts. Rows are kept apart by a number of their own, so that rows
of one doc_id, or of none, each have their own spans. Of parts of equal start the order of the
kinds decides. Very long texts and texts with very many parts work, as the parts of a text
are sorted with spill. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.sources.shared import written

#: Code points that may lie between two parts of one credential.
REACH = 200
#: Patterns keep to what all regular expression engines agree on; every run that could start
#: a match anywhere is bounded, so that long texts take time in proportion.
BREAK = r"\n[ \t\r]*\n"

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""


def _either(*words: str) -> str:
    """The words in either case; `_?` stands for an underscore that may be missing."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


# The base kinds, their patterns, the group whose length counts, the least length,
# the role in a credential, and what every match holds, so that other texts are not searched.
BASE = (
    ("assign", f"({_either('password', 'passwd', 'secret', 'token', 'api_?key')}){_VALUE}([A-Za-z0-9+/_.=-]+)", 2, 8, "secret", ""),
    ("access", "AKIA[A-Z0-9]+", 0, 16, "ident", "AKIA"),
    ("hex", "[0-9a-f]{32,}", 0, 32, "secret", ""),
)
#: The weak kinds. A token has to hold a digit, an upper-case and a lower-case letter.
WEAK = (
    ("ident", f"({_either('username', 'user_?id', 'user', 'login', 'account', 'client_?id', 'key_?id')}){_VALUE}([A-Za-z0-9@+_.-]+)", 2, 3, "ident", ""),
    ("email", r"[A-Za-z0-9+_.-]{1,64}@[A-Za-z0-9-]{1,63}(\.[A-Za-z0-9-]{1,63})+", 0, 6, "ident", "@"),
    ("secret", f"({_either('passphrase', 'password', 'passwd', 'pwd', 'credential', 'private_?key')}){_VALUE}" + r"""([^\x00-\x20"',;<>]+)""", 2, 4, "secret", ""),
    ("token", "[A-Za-z0-9+/_=-]{20,}", 0, 20, "secret", ""),
    ("endpoint", r"""[A-Za-z][A-Za-z0-9+.-]{0,15}://[^\x00-\x20"'<>]+""", 0, 8, "endpoint", "://"),
)
#: Weak kinds that are no candidates inside one of the others.
YIELDS = ("email", "token")
CARRIES_BOTH = r"""://[^\x00-\x20"'<>/@:]+:[^\x00-\x20"'<>/@]+@"""


def _fits(kind: str, match: Column, part: Column, least: int) -> Column:
    fits = F.length(part) >= least
    if kind == "token":
        fits &= match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return fits


def _found(text: Column, number: int, kind: str, pattern: str, group: int, least: int, _role: str, needle: str) -> Column:
    """Of every match of a kind: what lies before it and its own length, the empty lines
    before it, and whether it counts. Matches that don't count still move the others on."""
    whole = F.lit(f"({pattern})")
    matches = F.regexp_extract_all(text, whole, 1)
    parts = F.regexp_extract_all(text, whole, group + 1) if group else matches
    # Zipped first: what a lambda names of the text would be computed for every match.
    zipped = F.arrays_zip(matches.alias("match"), F.split(text, pattern, -1).alias("gap"), parts.alias("part"))
    each = F.transform(F.filter(zipped, lambda x: x["match"].isNotNull()), lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("place"),
        F.length(x["gap"]).alias("before"), F.length(x["match"]).alias("length"),
        (F.size(F.split(x["gap"], BREAK, -1)) - 1).alias("breaks"),
        _fits(kind, x["match"], x["part"], least).alias("fits"),
        (x["match"].rlike(CARRIES_BOTH) if kind == "endpoint" else F.lit(False)).alias("whole")))
    none = F.array().cast("array<struct<kind:int,place:int,before:int,length:int,breaks:int,fits:boolean,whole:boolean>>")
    return F.when((text.contains(needle) if needle else F.lit(True)) & text.rlike(pattern), each).otherwise(none)


def scanned(docs: DataFrame, base=BASE, weak=WEAK) -> DataFrame:
    """row (a number of its own), doc_id, parts: the matches of all kinds, in texts that have
    a base match or the parts of a credential; none elsewhere."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    kinds = [f"kind_{k}" for k in range(len(base) + len(weak))]
    rows = rows.select("row", "doc_id", *(_found(F.col("text"), k, *kind).alias(kinds[k]) for k, kind in enumerate((*base, *weak))))
    some = lambda which: reduce(Column.__or__, (F.exists(c, lambda x: x["fits"]) for c in which), F.lit(False))
    of = lambda role: [c for c, kind in zip(kinds, (*base, *weak)) if kind[4] == role]
    carried = reduce(Column.__or__, (F.exists(c, lambda x: x["whole"]) for c in kinds[len(base):]), F.lit(False))
    worth = some(kinds[: len(base)]) | carried | (some(of("ident")) & some(of("secret")))
    every = F.concat(*kinds)
    return rows.select("row", "doc_id", F.when(worth, every).otherwise(F.slice(every, 1, 0)).alias("parts"))


def _placed(scans: DataFrame) -> DataFrame:
    """row, doc_id, kind, start, end, scope, whole of every part that counts."""
    parts = scans.where(F.size("parts") > 0).select("row", "doc_id", F.explode("parts").alias("p")).select("row", "doc_id", "p.*")
    so_far = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.col("length")).over(so_far)
    # One exchange by row serves this window, the sweeps and the grouping.
    placed = parts.repartition("row").select("row", "doc_id", "kind", "fits", "whole", "length", end.alias("end"), F.sum("breaks").over(so_far).alias("scope"))
    return placed.where("fits").select(
        "row", "doc_id", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "scope", "whole")


def _nearest(which: Column, *scope: str) -> tuple[Column, Column]:
    """The last end before a part and the first start after it, of the parts of its scope
    that are of which. Both windows only ever grow, so that they take linear time."""
    up = Window.partitionBy(*scope).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*scope).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    return F.max(F.when(which, F.col("end"))).over(up), F.min(F.when(which, F.col("start"))).over(down)


def _free_of(parts: DataFrame, mine: Column, others: Column) -> DataFrame:
    """The parts without those of mine that overlap one of the others."""
    before, after = _nearest(others, "row")
    clash = (F.coalesce(before, F.lit(0)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    return parts.withColumn("clash", mine & clash).where("NOT clash").drop("clash")


def linked(placed: DataFrame, base=BASE, weak=WEAK, reach: int = REACH) -> DataFrame:
    """The parts that are no part of others, with reported: base, or with a complement in reach."""
    every = (*base, *weak)
    of = lambda test: F.col("kind").isin([k for k, kind in enumerate(every) if test(kind)])
    is_base, yields = F.col("kind") < len(base), of(lambda k: k[0] in YIELDS)
    parts = _free_of(placed, ~is_base, is_base)
    parts = _free_of(parts, yields, ~is_base & ~yields)
    near = {}
    for role in ("ident", "secret"):
        before, after = _nearest(of(lambda k, role=role: k[4] == role), "row", "scope")
        near[role] = F.coalesce(F.col("start") - before <= reach, F.lit(False)) | F.coalesce(after - F.col("end") <= reach, F.lit(False))
    parts = parts.select("*", near["ident"].alias("by_ident"), near["secret"].alias("by_secret"))
    is_role = lambda role: of(lambda k: k[4] == role)
    return parts.select("row", "doc_id", "kind", "start", "end", (
        is_base | (is_role("secret") & F.col("by_ident")) | (is_role("ident") & F.col("by_secret"))
        | (is_role("endpoint") & (F.col("whole") | (F.col("by_ident") & F.col("by_secret"))))).alias("reported"))


def secrets(docs: DataFrame, base=BASE, weak=WEAK, reach: int = REACH) -> DataFrame:
    """doc_id, spans: kind, start and end of every secret and confirmed part, by start and kind."""
    scans = written(scanned(docs, base, weak), "scans")
    names = F.lit([k[0] for k in (*base, *weak)])
    # Every text with parts keeps one of them at least, so each gets its row from the grouping.
    found = linked(_placed(scans), base, weak, reach).groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(
        F.when(F.col("reported"), F.struct("start", F.col("kind").alias("order"), "end")))).alias("spans"))
    named = F.transform("spans", lambda s: F.struct(
        F.get(names, s["order"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return found.select("doc_id", named.alias("spans")).unionByName(
        scans.where(F.size("parts") == 0).select("doc_id", none.alias("spans")))


def op11(docs: DataFrame) -> DataFrame:
    found = secrets(docs)
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    names = [k[0] for k in BASE]
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in names),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(names))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def oracle(base=BASE, weak=WEAK, reach: int = REACH) -> str:
    """The same rows by SQL that looks at every pair of parts of a text."""
    every = (*base, *weak)
    text = lambda x: "'" + x.replace("'", "''") + "'"
    scan = " UNION ALL ".join(
        f"""SELECT r, doc_id, {k} AS kind, '{role}' AS role, unnest(range(len(m))) AS place, unnest(m) AS m, unnest(p) AS p, unnest(g[1:len(m)]) AS g, {least} AS least FROM (
        SELECT r, doc_id, regexp_extract_all(t, {text(pattern)}, 0) AS m, regexp_extract_all(t, {text(pattern)}, {group}) AS p, string_split_regex(t, {text(pattern)}) AS g FROM texts)"""
        for k, (_, pattern, group, least, role, _) in enumerate(every))
    token = next(k for k, kind in enumerate(every) if kind[0] == "token")
    yields = f"({', '.join(str(k) for k, kind in enumerate(every) if kind[0] in YIELDS)})"
    names = [k[0] for k in every]
    overlap = "o.r = p.r AND o.\"end\" > p.start AND o.start < p.\"end\""
    near = lambda role: (f"EXISTS (SELECT 1 FROM free o WHERE o.r = p.r AND o.scope = p.scope AND o.role = '{role}' AND (o.start, o.kind) <> (p.start, p.kind) "  # noqa: E731
                         f"AND ((o.start, o.kind) < (p.start, p.kind) AND p.start - o.\"end\" <= {reach} OR (o.start, o.kind) > (p.start, p.kind) AND o.start - p.\"end\" <= {reach}))")
    return f"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    scan AS ({scan}),
    placed AS (SELECT *, sum(len(g) + len(m)) OVER w AS "end", sum(greatest(len(string_split_regex(g, '{BREAK}')) - 1, 0)) OVER w AS scope,
      len(p) >= least AND (kind <> {token} OR regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')) AS fits,
      role = 'endpoint' AND regexp_matches(m, {text(CARRIES_BOTH)}) AS whole
      FROM scan WINDOW w AS (PARTITION BY r, kind ORDER BY place)),
    parts AS (SELECT *, "end" - len(m) AS start FROM placed WHERE fits),
    open AS (SELECT * FROM parts p WHERE kind < {len(base)} OR NOT EXISTS (SELECT 1 FROM parts o WHERE o.kind < {len(base)} AND {overlap})),
    free AS (SELECT * FROM open p WHERE kind NOT IN {yields} OR NOT EXISTS (SELECT 1 FROM open o WHERE o.kind >= {len(base)} AND o.kind NOT IN {yields} AND {overlap})),
    linked AS (SELECT *, {near('ident')} AS by_ident, {near('secret')} AS by_secret FROM free p),
    spans AS (SELECT r, kind, start, concat_ws(':', {names}[kind + 1], start::BIGINT, "end"::BIGINT) AS span FROM linked
      WHERE kind < {len(base)} OR role = 'secret' AND by_ident OR role = 'ident' AND by_secret OR role = 'endpoint' AND (whole OR by_ident AND by_secret)),
    joined AS (SELECT r, {", ".join(f"count(*) FILTER (kind = {k}) AS n_{n}" for k, n in enumerate(names[: len(base)]))},
      string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {len(base)}) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in names[: len(base)])},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN joined USING (r)"""
