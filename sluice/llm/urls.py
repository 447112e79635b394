"""URL filter: rules, and trust and distrust spread over the links between hosts. No Python on the rows.

A rule is a host and the start of a path, to allow or to block. It fits its host and all
subdomains if the path of the url starts with its own; the longest rule that fits decides.

Pages without a rule are judged by their host. Trust is the personalised PageRank of hosts from
trusted seeds (hosts most of whose ruled pages are allowed) along the links; distrust that from
blocked seeds (most are blocked) against the links, so that it reaches hosts that link to
blocked ones. A host is blocked if its distrust is over ``THRESHOLD`` times its trust. Links are
the absolute ``href`` values of the pages between different hosts, each pair once; relative links stay on
their host. Mass is counted in whole units, 10 ** 30 in all, so results do not depend on the order of sums and
little is lost by rounding, however many seeds and links share it. Mass of hosts
without a link to follow goes back to the seeds. Rounds end when one moves a millionth of all mass at most
(``SETTLED``) and reaches no host that had none before; so mass goes along any number of links, until less
than a unit is left of it.

NULL urls and urls without ``://`` have an empty host and path and are allowed. NULL html has no links; long html is
searched whole. Rows are kept, repeated ones too (their links count once). Of equal ranks trust wins. An empty table
gives no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

#: (host and path, verdict)
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
UNITS = 10**30
WHOLE = "decimal(38,0)"
#: Units that the last round may still move, of trust and distrust together.
SETTLED = UNITS // 10**6
DAMPING, THRESHOLD = 85, 1  # damping in hundredths
HREF = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(lower(F.regexp_extract(after(url), "^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def after(url: Column) -> Column:
    """What follows the first ``://``; NULL without one."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``ruled`` (its verdict); the last two NULL without a rule."""
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block", r[0])):  # the last wins
        name, slash, start = text.partition("/")
        fits = (F.col("host") == name) | F.col("host").endswith(f".{name}")
        fits = fits & F.col("path").startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("ruled", verdict)


def links(pages: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of different hosts such that a page of one links to the other."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), lower))
    rows = pages.select(host_of(F.col("url")).alias("a"), F.explode(found).alias("b"))
    return rows.where("a <> '' AND a <> b").distinct()


def whole(units: int) -> Column:
    return F.lit(str(units)).cast(WHOLE)


def shared(mass: str, over: str, damping: int) -> Column:
    """``damping`` hundredths of the mass for each of so many, rounded down."""
    part = (F.col(mass) * whole(damping)).cast(WHOLE)
    parts = (F.col(over) * 100).cast("decimal(20,0)")
    return ((part - part % parts) / parts).cast(WHOLE)


def spread(ruled: DataFrame, edges: DataFrame, rounds: int | None = None, damping: int = DAMPING) -> DataFrame:
    """``host``, ``trust``, ``distrust`` (units of ``UNITS``) of every host that has a page or a link.

    After so many rounds, or when the ranks have settled.
    """
    edges = stored(edges)
    allowed = F.count(F.when(F.col("ruled") == "allow", 1))
    blocked = F.count(F.when(F.col("ruled") == "block", 1))
    own = ruled.where("host <> ''").groupBy("host").agg(allowed.alias("allowed"), blocked.alias("blocked"))
    ends = edges.select(F.col("a").alias("host"), F.lit(1).alias("outs"), F.lit(0).alias("ins")).unionAll(
        edges.select(F.col("b").alias("host"), F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("host").agg(F.sum("outs").alias("outs"), F.sum("ins").alias("ins"))
    hosts = own.join(ends, "host", "full").select(
        "host",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("outs", "ins")],
        (F.coalesce("allowed", F.lit(0)) > F.coalesce("blocked", F.lit(0))).alias("good"),
        (F.coalesce("blocked", F.lit(0)) > F.coalesce("allowed", F.lit(0))).alias("bad"),
    )
    hosts = stored(hosts)
    seeds = hosts.agg(F.count_if("good"), F.count_if("bad")).first()
    share, none = [UNITS // max(n, 1) for n in seeds], whole(0)
    state = stored(
        hosts.withColumn("trust", F.when(F.col("good"), whole(share[0])).otherwise(none)).withColumn(
            "distrust", F.when(F.col("bad"), whole(share[1])).otherwise(none)
        )
        # Whether trust and distrust have ever reached the host, what the last round moved, whom it reached.
        .withColumns({"known": F.col("good"), "accused": F.col("bad"), "moved": none, "fresh": F.lit(False)})
    )
    done = 0
    while rounds is None or done < rounds:
        lost = state.agg(
            F.coalesce(F.sum(F.when(F.col("outs") == 0, F.col("trust"))), none),
            F.coalesce(F.sum(F.when(F.col("ins") == 0, F.col("distrust"))), none),
            F.coalesce(F.sum("moved"), none),
            F.count_if("fresh"),
        ).first()
        if rounds is None and done and lost[2] <= SETTLED and not lost[3]:
            break
        done += 1
        kept = [
            whole(share[i] * (100 - damping) // 100 + int(lost[i]) * damping // (100 * max(seeds[i], 1))) for i in (0, 1)
        ]
        flow = edges.join(state, edges["a"] == state["host"]).select(
            F.col("b").alias("host"), shared("trust", "outs", damping).alias("t"), none.alias("d")
        )
        back = edges.join(state, edges["b"] == state["host"]).select(
            F.col("a").alias("host"), none.alias("t"), shared("distrust", "ins", damping).alias("d")
        )
        came = flow.unionAll(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        trust = (F.coalesce("t", none) + F.when(F.col("good"), kept[0]).otherwise(none)).cast(WHOLE)
        distrust = (F.coalesce("d", none) + F.when(F.col("bad"), kept[1]).otherwise(none)).cast(WHOLE)
        moved = F.abs(trust - F.col("trust")) + F.abs(distrust - F.col("distrust"))
        state = stored(
            state.join(came, "host", "left").select(
                *["host", "outs", "ins", "good", "bad"],
                trust.alias("trust"),
                distrust.alias("distrust"),
                (F.col("known") | (trust > 0)).alias("known"),
                (F.col("accused") | (distrust > 0)).alias("accused"),
                moved.cast(WHOLE).alias("moved"),
                ((~F.col("known") & (trust > 0)) | (~F.col("accused") & (distrust > 0))).alias("fresh"),
            )
        )
    return state.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules=RULES, threshold: int = THRESHOLD) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every page."""
    ruled = with_rules(pages, rules)
    hosts = spread(ruled, links(pages)).where(F.col("distrust") > F.col("trust") * threshold)
    hosts = hosts.select(F.col("host").alias("of"), F.lit("block").alias("spread"))
    verdict = F.coalesce("ruled", "spread", F.lit("allow"))
    rows = ruled.join(hosts, ruled["host"] == hosts["of"], "left")
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def sql() -> str:
    """The same rows. Each round of the recursion is one of the ranks; it ends when they have settled."""
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END"
    az = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    rule = verdict = "NULL"
    for text, says in sorted(RULES, key=lambda r: len(r[0])):
        name, slash, start = text.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{start}')"
        rule = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{says}' ELSE {verdict} END"
    href = HREF.replace("'", "''")
    units = f"{UNITS}::HUGEINT"

    def kept(seeds: str, lost: str) -> str:
        return f"{units} // n.{seeds} * {100 - DAMPING} // 100 + {lost} * {DAMPING} // (100 * n.{seeds})"

    return f"""
WITH RECURSIVE u AS MATERIALIZED (
    SELECT page_id, html, coalesce(translate(regexp_extract({rest}, '^([^/?#]*)', 1), {az}), '') AS host,
           coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), p AS MATERIALIZED (
    SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled FROM u
), e AS MATERIALIZED (
    SELECT DISTINCT a, b FROM (
        SELECT host AS a, translate(unnest(regexp_extract_all(html, '{href}', 1)), {az}) AS b FROM u
    ) WHERE a <> '' AND a <> b
), h AS MATERIALIZED (
    SELECT host, CAST(sum(o) AS BIGINT) AS outs, CAST(sum(i) AS BIGINT) AS ins, sum(y) > sum(x) AS good, sum(x) > sum(y) AS bad FROM (
        SELECT host, 0 AS o, 0 AS i, CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END AS y, CASE WHEN ruled = 'block' THEN 1 ELSE 0 END AS x
        FROM p WHERE host <> ''
        UNION ALL SELECT a, 1, 0, 0, 0 FROM e UNION ALL SELECT b, 0, 1, 0, 0 FROM e
    ) GROUP BY host
), n AS MATERIALIZED (
    SELECT greatest(count(*) FILTER (good), 1) AS g, greatest(count(*) FILTER (bad), 1) AS b FROM h
), s AS (
    SELECT h.*, CASE WHEN good THEN {units} // n.g ELSE 0::HUGEINT END AS trust,
           CASE WHEN bad THEN {units} // n.b ELSE 0::HUGEINT END AS distrust,
           good AS known, bad AS accused, FALSE AS settled, 0 AS round
    FROM h, n
    UNION ALL
    SELECT host, outs, ins, good, bad, trust, distrust, known OR trust > 0, accused OR distrust > 0,
           sum(moved) OVER () <= {SETTLED}::HUGEINT AND count(*) FILTER (
               (NOT known AND trust > 0) OR (NOT accused AND distrust > 0)) OVER () = 0,
           round + 1
    FROM (
        SELECT host, outs, ins, good, bad, known, accused, round, t AS trust, d AS distrust,
               abs(t - trust) + abs(d - distrust) AS moved
        FROM (
            SELECT s.*, coalesce(c.t, 0) + CASE WHEN good THEN {kept("g", "l.t")} ELSE 0 END AS t,
                   coalesce(c.d, 0) + CASE WHEN bad THEN {kept("b", "l.d")} ELSE 0 END AS d
            FROM s LEFT JOIN (
                SELECT host, sum(t) AS t, sum(d) AS d FROM (
                    SELECT e.b AS host, trust * {DAMPING} // (100 * outs) AS t, 0::HUGEINT AS d FROM e JOIN s ON e.a = s.host
                    UNION ALL
                    SELECT e.a, 0, distrust * {DAMPING} // (100 * ins) FROM e JOIN s ON e.b = s.host
                ) GROUP BY host
            ) AS c ON s.host = c.host, (
                SELECT coalesce(sum(trust) FILTER (outs = 0), 0) AS t, coalesce(sum(distrust) FILTER (ins = 0), 0) AS d FROM s
            ) AS l, n
            WHERE NOT settled
        )
    )
), last AS (
    SELECT * FROM s WHERE round = (SELECT max(round) FROM s)
)
SELECT page_id, p.host, path, rule,
       coalesce(ruled, CASE WHEN last.distrust > last.trust * {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN last ON p.host = last.host
"""
