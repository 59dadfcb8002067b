"""Mixing sources to target weights by iterative proportional fitting, with DataFrame and SQL functions only.

Documents are pre-aggregated to cells of (source, language, topic). Each sweep scales the cells' factors so that the expected tokens
of the sample meet the source, then the language, then the topic goals. A cell's probability is its factor, 1 at most: a step fixes the
cells that reach 1 at all their tokens and scales the others to what those leave, so that the bound is met inside the sweep and not
after it. A hash of the id decides about each document.

The sample holds the share ``keep`` of all tokens, or as much less as the scarcest target value needs to be met, down to ``LEAST``. Beyond
that a scarce value is taken whole, the other values of its margin take up the rest, and ``margins`` shows what was missed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import broadcast_if_bounded
from tagmill.session import cut

MARGINS = ("source", "lang", "topic")
#: Sweeps end when no margin value is off its goal by more than TOLERANCE of it, or after SWEEPS of them.
SWEEPS = 30
TOLERANCE = 1e-3
#: Exponent of the default targets: shares of tokens, flattened so that a hot source cannot dominate.
TEMPER = 0.5
#: Share of all tokens that the sample should hold in expectation, and the least that scarce values may lower it to.
KEEP = 0.5
LEAST = 0.1
SEED = "mix"
_DRAW_DIGITS = 13


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, contact data, figures, or prose."""
    return F.when(F.contains(text, F.lit(" | ")), "tables").when(F.contains(text, F.lit("@")), "contact").when(text.rlike("[0-9]"), "figures").otherwise("prose")


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens): null margins are 'unknown', tokens are runs without white space."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    known = [F.coalesce(F.col(m), F.lit("unknown")).alias(m) for m in ("source", "lang")]
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), *known, topic_of(text).alias("topic"), F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("n_tokens"))


def _scaled(rows: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """``rows`` with factors ``a`` scaled so that sum(min(1, a) tokens) is ``goal`` in each group, and ``off``, how far it was.

    Rows are passed in ascending order of ``a``. A row is full if its group stays within the goal when the row's probability reaches 1. Full rows
    give all their tokens, and the others are scaled to the rest. ``goal`` is at most the group's tokens.
    """
    group = Window.partitionBy(*([F.col(k) for k in keys] or [F.lit(0)]))
    lower = group.orderBy("a", *ties).rowsBetween(Window.unboundedPreceding, -1)
    part = rows.select(
        "*",
        F.coalesce(F.sum(F.col("a") * F.col("tokens")).over(lower), F.lit(0.0)).alias("_rest"),
        (F.sum("tokens").over(group) - F.coalesce(F.sum("tokens").over(lower), F.lit(0))).alias("_upper"),
        F.sum(F.least(F.lit(1.0), "a") * F.col("tokens")).over(group).alias("_before"),
        F.min(F.when(F.col("a") > 0, F.col("a"))).over(group).alias("_least"),
    )
    part = part.withColumn("_full", (F.col("a") > 0) & (F.col("_upper") + F.col("_rest") / F.col("a") <= F.col("goal")))
    part = part.withColumn("_taken", F.sum(F.when(F.col("_full"), F.col("tokens")).otherwise(0)).over(group))
    part = part.withColumn("_open", F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("a") * F.col("tokens"))).over(group))
    left = F.greatest(F.col("goal") - F.col("_taken"), F.lit(0.0))
    factor = F.when(F.col("_open") > 0, left / F.col("_open")).otherwise(F.coalesce(1 / F.col("_least"), F.lit(0.0)))
    off = F.when(F.col("goal") > 0, F.abs(F.col("_before") - F.col("goal")) / F.col("goal")).otherwise(0.0)
    own = [c for c in rows.columns if c not in ("a", "off")]
    return part.select(*own, (F.col("a") * factor).alias("a"), F.greatest("off", off).alias("off"))


def _target(cells: DataFrame, margin: str, given: Mapping[str, float] | None, temper: float) -> DataFrame:
    """(value, tokens, share) of a margin: the given shares of values that hold tokens, or tempered shares of tokens, normalised."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("tokens"))
    if given:
        rule = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in given.items() for x in kv]), F.col("value")), F.lit(0.0))
    else:
        rule = F.pow("tokens", F.lit(temper))
    known = cut(sums.where("tokens > 0").withColumn("share", rule.cast("double")))
    total = known.agg(F.sum("share")).first()[0]
    return known.withColumn("share", F.col("share") / (total or 1.0))


def budget(targets: Mapping[str, DataFrame], keep: float = KEEP, least: float = LEAST) -> float:
    """The tokens that the sample should hold: ``keep`` of all, less if a target value is scarcer, ``least`` of all at least."""
    total, room, scarce = 0, [], []
    for target in targets.values():
        wanted = F.col("share") > 0
        row = target.agg(F.sum("tokens"), F.sum(F.when(wanted, F.col("tokens"))), F.min(F.when(wanted, F.col("tokens") / F.col("share")))).first()
        if not row[1]:
            return 0.0
        total, room, scarce = row[0], [*room, row[1]], [*scarce, row[2]]
    return float(min(*room, max(min(keep * total, *scarce), min(keep, least) * total)))


def goals(targets: Mapping[str, DataFrame], tokens: float) -> dict[str, DataFrame]:
    """For each margin (value, tokens, share, goal): the tokens wanted of each value, none above what it holds, ``tokens`` together."""
    found = {}
    for margin, target in targets.items():
        rows = target.select("value", "tokens", "share", F.lit(tokens).alias("goal"), (F.col("share") / F.col("tokens")).alias("a"), F.lit(0.0).alias("off"))
        filled = _scaled(rows, [], ["value"])
        found[margin] = cut(filled.select("value", "tokens", "share", (F.least(F.lit(1.0), "a") * F.col("tokens")).alias("goal")))
    return found


def rake(cells: DataFrame, wanted: Mapping[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with probability ``p`` and expected tokens ``w``, which meet the goals of every margin as far as the cells allow."""
    now = cells.withColumn("a", F.lit(1.0))
    for _ in range(sweeps):
        now = now.withColumn("off", F.lit(0.0))
        for margin, goal in wanted.items():
            side = goal.select(F.col("value").alias("_value"), "goal")
            now = _scaled(now.join(side, F.col(margin) == F.col("_value")).drop("_value"), [margin], list(MARGINS)).drop("goal")
        now = cut(now)
        off = now.agg(F.max("off")).first()[0]
        if off is None or off <= tolerance:
            break
    p = F.least(F.lit(1.0), "a")
    return now.select(*cells.columns, p.alias("p"), (p * F.col("tokens")).alias("w"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, _DRAW_DIGITS), 16, 10).cast("double") / float(16**_DRAW_DIGITS)


def calibrated(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP, sweeps: int = SWEEPS, temper: float = TEMPER, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(descriptions, cells with tokens, weight w and probability p) of ``docs``, which needs columns source and lang."""
    rows = described(docs, id_col, text_col)
    cells = cut(rows.groupBy(*MARGINS).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")))
    chances, _ = _solved(cells, targets, keep, sweeps, temper)
    return rows, chances


def _solved(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None, keep: float, sweeps: int, temper: float) -> tuple[DataFrame, dict[str, DataFrame]]:
    aims = {m: _target(cells, m, (targets or {}).get(m), temper) for m in MARGINS}
    tokens = budget(aims, keep)
    wanted = goals(aims, tokens)
    if not tokens:
        return cells.select("*", F.lit(0.0 if cells.where("tokens > 0").head(1) else keep).alias("p"), F.lit(0.0).alias("w")), wanted
    empty = cells.where("tokens = 0").select("*", F.lit(0.0).alias("p"), F.lit(0.0).alias("w"))
    return cut(rake(cells.where("tokens > 0"), wanted, sweeps).unionByName(empty)), wanted


def margins(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP, sweeps: int = SWEEPS, temper: float = TEMPER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(margin, value, tokens, share, reached, feasible) of every margin value that holds tokens: its tokens, its target share, the share
    of the sample that it gets in expectation, and whether it has tokens enough for the target."""
    cells = cut(described(docs, id_col, text_col).groupBy(*MARGINS).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")))
    chances, wanted = _solved(cells, targets, keep, sweeps, temper)
    total = chances.agg(F.sum("w")).first()[0] or 1.0
    found = None
    for margin, goal in wanted.items():
        got = chances.groupBy(F.col(margin).alias("_value")).agg((F.sum("w") / F.lit(total)).alias("reached"))
        feasible = F.col("share") * F.sum("goal").over(Window.partitionBy(F.lit(0))) <= F.col("tokens") * (1 + 1e-9)
        rows = goal.withColumn("feasible", feasible).join(got, F.col("value") == F.col("_value")).select(F.lit(margin).alias("margin"), "value", "tokens", "share", "reached", "feasible")
        found = rows if found is None else found.unionByName(rows)
    return found


def mixed(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The sampled rows of ``docs`` as they are, with topic, n_tokens, weight (the cell's share of the sample over its share of all tokens) and
    probability beside them; input columns of those four names are replaced. No text is shuffled: cells are joined to the rows.

    Null texts are empty and have no tokens; a cell without tokens has probability 0 (unless no cell has any: then ``keep``). Null
    source or language counts as 'unknown'; a target for a value that does not occur is left out and the rest normalised; a null
    id draws like an empty one; rows that repeat an id are kept or left together. An empty table gives an empty result.
    """
    _, cells = calibrated(docs, targets, keep, id_col=id_col, text_col=text_col, **options)
    total = cells.agg(F.sum("tokens").alias("t"), F.sum("w").alias("w")).first()
    share = F.col("w") / (total["w"] or 1.0) / F.when(F.col("tokens") > 0, F.col("tokens") / (total["t"] or 1.0)).otherwise(1.0)
    known = cells.select(F.struct(*MARGINS).alias("_cell"), F.struct(F.round("p", 6).alias("probability"), F.round(share, 6).alias("weight"), "p").alias("_mix"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    cell = F.struct(*[F.coalesce(F.col(m), F.lit("unknown")).alias(m) for m in ("source", "lang")], topic_of(text).alias("topic"))
    rows = docs.drop("topic", "n_tokens", "weight", "probability").select("*", cell.alias("_at"), F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("n_tokens"))
    joined = rows.join(broadcast_if_bounded(known, 256), F.col("_at") == F.col("_cell")).where(draw(F.col(f"`{id_col}`")) < F.col("_mix.p"))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("topic", "n_tokens", "weight", "probability")]
    return joined.select(*own, F.col("_at.topic").alias("topic"), "n_tokens", F.col("_mix.weight").alias("weight"), F.col("_mix.probability").alias("probability"))


def sample(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each document that ``mixed`` samples: id, source, lang ('unknown' if null), topic, n_tokens, weight and probability."""
    rows = mixed(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), "source", "lang"), targets, keep, id_col, text_col, **options)
    known = [F.coalesce(F.col(m), F.lit("unknown")).alias(m) for m in ("source", "lang")]
    return rows.select(id_col, *known, "topic", "n_tokens", "weight", "probability")


def _scaled_sql(rows: str, key: str | None, ties: str, kept: str, done: str = "false") -> str:
    """``_scaled`` as DuckDB text; factors stay as they are once ``done`` holds."""
    part, order = f"PARTITION BY {key}" if key else "", f"ORDER BY a, {ties} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""SELECT {kept}, a * CASE WHEN {done} THEN 1 WHEN open > 0 THEN greatest(goal - taken, 0) / open ELSE coalesce(1 / lowest, 0) END AS a,
        greatest(off, CASE WHEN goal > 0 THEN abs(earlier - goal) / goal ELSE 0 END) AS off
    FROM (SELECT *, sum(CASE WHEN brim THEN tokens ELSE 0 END) OVER ({part}) AS taken, sum(CASE WHEN brim THEN 0 ELSE a * tokens END) OVER ({part}) AS open
    FROM (SELECT *, a > 0 AND upper + rest / CASE WHEN a > 0 THEN a END <= goal AS brim
    FROM (SELECT *, coalesce(sum(a * tokens) OVER ({part} {order}), 0) AS rest, sum(tokens) OVER ({part}) - coalesce(sum(tokens) OVER ({part} {order}), 0) AS upper,
        sum(least(1, a) * tokens) OVER ({part}) AS earlier, min(CASE WHEN a > 0 THEN a END) OVER ({part}) AS lowest FROM ({rows}) r0) r1) r2) r3"""


def oracle_sql(sweeps: int = SWEEPS, keep: float = KEEP, temper: float = TEMPER) -> str:
    """The whole of ``sample`` with default targets as DuckDB text, its sweeps unrolled."""
    steps = [
        r"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
        CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'tables' WHEN contains(coalesce(text, ''), '@') THEN 'contact'
             WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures' ELSE 'prose' END AS topic,
        CAST(len(regexp_extract_all(coalesce(text, ''), '\S+')) AS BIGINT) AS n_tokens FROM documents)""",
        "w0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(1 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS off FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    for m in MARGINS:
        steps.append(f"t_{m} AS MATERIALIZED (SELECT {m} AS value, sum(tokens) AS tokens, pow(sum(tokens), {temper}) / sum(pow(sum(tokens), {temper})) OVER () AS share FROM w0 GROUP BY {m})")
    scarce = ", ".join(f"(SELECT min(tokens / share) FROM t_{m})" for m in MARGINS)
    steps.append(f"b AS MATERIALIZED (SELECT sum(tokens) AS t, greatest(least({keep} * sum(tokens), {scarce}), {min(keep, LEAST)} * sum(tokens)) AS goal FROM w0)")
    for m in MARGINS:
        rows = f"SELECT value, t_{m}.tokens, b.goal, share / t_{m}.tokens AS a, 0 AS off FROM t_{m}, b"
        steps.append(f"g_{m} AS MATERIALIZED (SELECT value, least(1, a) * tokens AS goal FROM ({_scaled_sql(rows, None, 'value', 'value, tokens')}) x)")
    steps.append("s0 AS MATERIALIZED (SELECT false AS done)")
    n = 0
    for i in range(sweeps):
        for m in MARGINS:
            off = "0.0" if m == MARGINS[0] else "c.off"
            rows = f"SELECT c.source, c.lang, c.topic, c.tokens, c.a, {off} AS off, g.goal FROM w{n} c JOIN g_{m} g ON c.{m} = g.value"
            n += 1
            steps.append(f"w{n} AS MATERIALIZED ({_scaled_sql(rows, m, ', '.join(MARGINS), 'source, lang, topic, tokens', f'(SELECT done FROM s{i})')})")
        steps.append(f"s{i + 1} AS MATERIALIZED (SELECT (SELECT done FROM s{i}) OR coalesce(max(off), 0) <= {TOLERANCE} AS done FROM w{n})")
    steps.append(f"p AS MATERIALIZED (SELECT source, lang, topic, tokens, least(1, a) AS p, sum(least(1, a) * tokens) OVER () AS w, sum(tokens) OVER () AS t FROM w{n})")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, n_tokens, round(p.p * p.tokens / p.w / (p.tokens / p.t), 6) AS weight, round(p.p, 6) AS probability
FROM d JOIN p USING (source, lang, topic)
WHERE CAST('0x' || substr(md5('{SEED}' || CAST(doc_id AS VARCHAR)), 1, {_DRAW_DIGITS}) AS BIGINT) / {16**_DRAW_DIGITS}.0 < p.p"""
    )
