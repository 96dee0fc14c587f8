"""Named queries of the training-text problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.llm import canonical, mixing, neardup, packing, spans, tokens
from stratakit.plans.registry import Registry
from stratakit.session import cut, table

registry = Registry()

# ---------------------------------------------------------------- 4: near-duplicate records with small edits

READINGS = ["depth", "qc", "fs", "u2"]
SIMILAR = 0.6

_PAIRS = """
r AS (SELECT DISTINCT cpt_id, depth, qc, fs, u2 FROM cptmeasurements),
n AS (SELECT cpt_id, count(*) AS n FROM r GROUP BY cpt_id),
c AS (SELECT a.cpt_id AS a, b.cpt_id AS b, count(*) AS k FROM r a JOIN r b ON a.depth IS NOT DISTINCT FROM b.depth
  AND a.qc IS NOT DISTINCT FROM b.qc AND a.fs IS NOT DISTINCT FROM b.fs AND a.u2 IS NOT DISTINCT FROM b.u2 AND a.cpt_id < b.cpt_id
  GROUP BY ALL),
found AS (SELECT a AS cpt_id_a, b AS cpt_id_b FROM c JOIN n x ON x.cpt_id = a JOIN n y ON y.cpt_id = b WHERE k >= 0.6 * (x.n + y.n - k))
"""


def _similar(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return neardup.similar_classes(table(spark, d, "cptmeasurements"), "cpt_id", READINGS, SIMILAR)


@registry.query(f"WITH {_PAIRS} SELECT cpt_id_a, cpt_id_b FROM found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.similar_records(*_similar(spark, d))
    return pairs.select(F.col("id_a").alias("cpt_id_a"), F.col("id_b").alias("cpt_id_b"))


@registry.query(f"""WITH RECURSIVE {_PAIRS}, link AS (SELECT cpt_id_a AS a, cpt_id_b AS b FROM found UNION SELECT cpt_id_b, cpt_id_a FROM found),
  walk AS (SELECT cpt_id AS id, cpt_id AS seen FROM n UNION SELECT walk.id, link.b FROM walk JOIN link ON link.a = walk.seen)
  SELECT id AS cpt_id, min(seen) AS group_id FROM walk GROUP BY id""")
def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every sounding with the group it belongs to, named by the group's smallest id."""
    membership, links = _similar(spark, d)
    reps = membership.select(F.col("rep").alias("id")).distinct()
    grouped = neardup.components(reps, links)
    out = membership.join(grouped.select(F.col("id").alias("rep"), "component"), "rep")
    return out.select(F.col("id").alias("cpt_id"), F.col("component").alias("group_id"))


# ---------------------------------------------------------------- 6: mapping free-entered values to a canonical list


@registry.query()
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    typed = table(spark, d, "extractedsinglevalues")
    fields = ["termination_reason", "ground_water_level_note"]
    values = typed.select("value_id", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])))
    return canonical.canonical(values, table(spark, d, "referenceentry"))


# ---------------------------------------------------------------- 7: filling fixed-capacity containers


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", "source", tokens.token_count(F.col("text")).alias("tokens"))


@registry.query()
def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every text, or piece of one, with its container and the container's fill."""
    return packing.pack(_sized(spark, d), table(spark, d, "containersize"))


@registry.query()
def p7_summary(spark: SparkSession, d: str) -> DataFrame:
    return packing.summary(p7_packing(spark, d))


@registry.query("""SELECT container, capacity_tokens, (SELECT count(*) FROM documents) AS items, 0 AS incomplete, 0 AS split_needlessly, 0 AS overfull
  FROM containersize""")
def p7_violations(spark: SparkSession, d: str) -> DataFrame:
    """Per container the items, and the containers and items that break a rule: none in a sound packing."""
    sized = cut(_sized(spark, d))
    return packing.violations(packing.pack(sized, table(spark, d, "containersize")), sized)


# ---------------------------------------------------------------- 8: mixing sources to target weights


@registry.query()
def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture, in order."""
    return mixing.mix(_sized(spark, d), table(spark, d, "mixtarget"))


@registry.query()
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    sized = cut(_sized(spark, d))
    targets = table(spark, d, "mixtarget")
    return mixing.shares(mixing.mix(sized, targets), targets, sized)


@registry.query("""SELECT m.source, min(max_repeats) AS uses_allowed, (SELECT count(*) FROM documents d WHERE d.source = m.source AND length(text) > 0) AS records,
  0 AS overused, 0 AS unknown FROM mixtarget m WHERE target_share > 0 AND max_repeats >= 1 GROUP BY m.source""")
def p8_violations(spark: SparkSession, d: str) -> DataFrame:
    """Per target source its records and the records that break a rule of the mixture: none in a sound one."""
    sized = cut(_sized(spark, d))
    targets = table(spark, d, "mixtarget")
    return mixing.violations(mixing.mix(sized, targets), targets, sized)


# ---------------------------------------------------------------- 9: long exact spans shared between records


@registry.query("""WITH w AS (SELECT DISTINCT doc_id, hash(substr(text, i, 200)) AS h FROM (
    SELECT doc_id, text, unnest(generate_series(1, length(text) - 199)) AS i FROM documents WHERE length(text) >= 200))
  SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM w a JOIN w b ON a.h = b.h AND a.doc_id < b.doc_id""")
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.sharing_pairs(cut(spans.occurrences(table(spark, d, "documents"))))


@registry.query("""WITH t AS (SELECT doc_id, coalesce(max(length(text)), 0) AS n_chars FROM documents GROUP BY doc_id),
  w AS (SELECT doc_id, i, hash(substr(text, i, 200)) AS h FROM (
    SELECT doc_id, text, unnest(generate_series(1, length(text) - 199)) AS i FROM documents WHERE length(text) >= 200)),
  s AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1),
  c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 199)) AS at FROM w WHERE h IN (SELECT h FROM s)),
  n AS (SELECT doc_id, count(*) AS shared_chars FROM c GROUP BY doc_id)
  SELECT doc_id, n_chars, coalesce(shared_chars, 0) AS shared_chars,
    CASE WHEN n_chars > 0 THEN coalesce(shared_chars, 0)::DOUBLE / n_chars ELSE 0.0::DOUBLE END AS share FROM t LEFT JOIN n USING (doc_id)""")
def p9_cover(spark: SparkSession, d: str) -> DataFrame:
    """How much of each text is shared elsewhere."""
    docs = table(spark, d, "documents")
    return spans.shared_cover(docs, cut(spans.occurrences(docs)))
