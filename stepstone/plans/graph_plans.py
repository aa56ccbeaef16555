"""Graph queries over the edge view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.operators import cycles, graph, reachability, stats
from stepstone.plans.merge_plans import published
from stepstone.plans.registry import query
from stepstone.sources import tables as src
from stepstone.sources.tables import with_views

TEMPLATES = ("order R",)

REACH = """
, links AS (SELECT prerequisite_id AS s, topic_id AS d FROM {edges}),
reach(s, d) AS (SELECT s, d FROM links UNION SELECT r.s, l.d FROM reach r JOIN links l ON r.d = l.s)"""
SCC = REACH.format(edges="edges") + """,
scc AS (SELECT a.s AS id, min(a.d) AS scc, count(*) AS n FROM reach a JOIN reach b ON a.s = b.d AND a.d = b.s
  GROUP BY a.s HAVING count(*) > 1)"""
COUNTS = REACH.format(edges="pub_edges") + """,
counted AS (SELECT id FROM pub_topics WHERE node_kind IN ('concept', 'skill')),
counts AS (SELECT c.id, coalesce(h.n, 0) AS reach FROM counted c LEFT JOIN
  (SELECT s, count(*) AS n FROM reach WHERE d IN (SELECT id FROM counted) GROUP BY s) h ON h.s = c.id)"""
CENTRALITY = COUNTS + """,
central AS (SELECT t.id, round(c.reach::DOUBLE / greatest((SELECT max(reach) FROM counts), 1), 6) AS centrality
  FROM pub_topics t LEFT JOIN counts c ON t.id = c.id)"""


def published_centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, kept = published(spark, sf_dir)
    return src.written(spark, sf_dir, "centrality", lambda: reachability.centrality(nodes, graph.links(kept)))


def all_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.written(
        spark, sf_dir, "scc", lambda: graph.components(graph.links(src.edges(spark, sf_dir)))
    )


def broken_cycles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    edges = src.edges(spark, sf_dir)
    removed = src.written(spark, sf_dir, "removed", lambda: cycles.break_cycles(edges, TEMPLATES)[1])
    keys = ["topic_id", "prerequisite_id"]
    return edges.join(removed, keys, "left_anti"), removed


@query("g1_reach_counts", with_views("pub_edges") + COUNTS + " SELECT id, reach FROM counts")
def reach_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, kept = published(spark, sf_dir)
    return reachability.reach_counts(nodes, graph.links(kept))


@query("g1_reach_sketch")
def reach_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate mode: an estimate takes the place of the count."""
    nodes, kept = published(spark, sf_dir)
    return reachability.reach_counts(nodes, graph.links(kept), exact=False)


@query("g2_centrality", with_views("pub_edges") + CENTRALITY + " SELECT id, centrality FROM central")
def centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_centrality(spark, sf_dir)


STORED_SQL = """, stored AS (SELECT id, CASE WHEN num % 10 = 0 THEN centrality + 0.5 WHEN num % 10 = 1 THEN NULL ELSE centrality END AS centrality
  FROM central JOIN pub_topics USING (id))"""


def stored_centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centrality as kept with the topics: every tenth value is off, every tenth is missing."""
    num = src.topics(spark, sf_dir).select("id", "num")
    rest = F.col("num") % 10
    return published_centrality(spark, sf_dir).join(num.hint("merge"), "id").select(
        "id", F.when(rest == 0, F.col("centrality") + 0.5).when(rest != 1, F.col("centrality")).alias("centrality")
    )


@query(
    "g3_stale_centrality",
    with_views("pub_edges") + CENTRALITY + STORED_SQL
    + " SELECT s.id, s.centrality AS stored, c.centrality AS expected FROM stored s JOIN central c ON s.id = c.id WHERE s.centrality IS DISTINCT FROM c.centrality",
)
def stale_centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.stale_centrality(stored_centrality(spark, sf_dir), published_centrality(spark, sf_dir))


@query("g4_components", with_views("edges") + SCC + " SELECT id, scc FROM scc")
def strongly_connected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_components(spark, sf_dir)


@query(
    "g5_edge_scores",
    with_views("edges")
    + """
, ind AS (SELECT topic_id, count(*) AS n FROM edges GROUP BY 1), outd AS (SELECT prerequisite_id, count(*) AS n FROM edges GROUP BY 1)
SELECT e.topic_id, e.prerequisite_id, i.n + o.n AS degree,
  round((CASE WHEN strength = 'soft' THEN 1.0::DOUBLE ELSE 0 END) + (CASE WHEN contains(reason, 'order R') THEN 0.5::DOUBLE ELSE 0 END)
    + 0.3::DOUBLE / (i.n + o.n), 6) AS score,
  CASE WHEN strength = 'soft' THEN 'cycle-soft' WHEN contains(reason, 'order R') THEN 'cycle-template' ELSE 'cycle-lowdeg' END AS removed_reason
FROM edges e JOIN ind i ON i.topic_id = e.topic_id JOIN outd o ON o.prerequisite_id = e.prerequisite_id""",
)
def edge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cycles.scored_edges(src.edges(spark, sf_dir), TEMPLATES)
    return scored.select(
        "topic_id", "prerequisite_id", "degree", F.round("score", 6).alias("score"), "removed_reason"
    )


@query("g6_break_cycles")
def break_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_cycles(spark, sf_dir)[1].select("topic_id", "prerequisite_id", "removed_reason")


STATS_SELECT = """
SELECT (SELECT count(*) FROM (SELECT s FROM links UNION SELECT d FROM links)) AS nodes, (SELECT count(*) FROM links) AS edges,
  round((SELECT count(*) FROM links)::DOUBLE / (SELECT count(*) FROM (SELECT s FROM links UNION SELECT d FROM links)), 6) AS density,
  (SELECT count(DISTINCT scc) FROM scc) AS cyclic_components, (SELECT count(*) FROM scc) AS nodes_in_cycles,
  (SELECT coalesce(max(n), 0) FROM scc) AS largest_component"""


@query("a7_graph_stats", with_views("edges") + SCC + STATS_SELECT)
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_stats(graph.links(src.edges(spark, sf_dir)), all_components(spark, sf_dir))


@query(
    "g7_removal_gate",
    with_views("edges") + SCC + f""", st AS ({STATS_SELECT}),
twoway AS (SELECT count(*) AS n FROM links a JOIN links b ON a.s = b.d AND a.d = b.s WHERE a.s < a.d)
SELECT rule FROM (SELECT 'too-many-removals' AS rule, edges - nodes > greatest(twoway.n * 1.6, 320) AS broken FROM st, twoway
  UNION ALL SELECT 'density-out-of-range', NOT density BETWEEN 1.35 AND 1.55 FROM st
  UNION ALL SELECT 'still-cyclic', cyclic_components > 0 FROM st) x WHERE broken""",
)
def removal_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the gate is asked about the graph as it came, so that its rules have something to report
    edges = src.edges(spark, sf_dir)
    found = graph.graph_stats(graph.links(edges), all_components(spark, sf_dir))
    pairs = stats.antiparallel_pairs(edges).scalar()
    return cycles.removal_gate(found, F.col("edges") - F.col("nodes"), pairs)


@query("g7_broken_gate")
def broken_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate as it is meant: over the edges that cycle breaking removed and those that it left."""
    edges = src.edges(spark, sf_dir)
    kept, removed = broken_cycles(spark, sf_dir)
    left = graph.links(kept)
    found = graph.graph_stats(left, graph.components(left))
    return cycles.removal_gate(found, removed.agg(F.count("*")).scalar(), stats.antiparallel_pairs(edges).scalar())


@query(
    "g8_unsortable",
    with_views("edges") + """, kept AS (SELECT * FROM edges WHERE review_status <> 'rejected')"""
    + REACH.format(edges="kept")
    + " SELECT DISTINCT d AS id FROM reach WHERE s IN (SELECT s FROM reach WHERE s = d) ",
)
def unsortable(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = src.edges(spark, sf_dir).where("review_status <> 'rejected'")
    return graph.unsortable(graph.links(kept))


def topic_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence per subject over published topics, with the position in the whole subject."""
    from stepstone.operators.ordering import with_position

    def build() -> DataFrame:
        nodes, kept = published(spark, sf_dir)
        named = nodes.select("id", "subject", "age_start", F.collate("name", "zh_Hans_CHN").alias("zh_name"))
        ordered = graph.sequence(named, graph.links(kept), "subject", ["age_start", "zh_name", "id"])
        placed = with_position(ordered.withColumn("late", ~F.col("sortable")), ["subject"], ["late", "path"])
        return placed.select("subject", "id", "pos", "sortable")

    return src.written(spark, sf_dir, "sequence", build)


@query("g9_topic_sequence")
def sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_sequence(spark, sf_dir)


CURRENT_SQL = """, here AS (SELECT learner, arg_max(topic_id, event_id) AS id FROM decisions WHERE topic_id IN
  (SELECT topic_id FROM pub_edges UNION SELECT prerequisite_id FROM pub_edges) GROUP BY learner)"""


def learner_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(mastered, current): folded decisions, and the last topic with neighbours each learner touched."""
    from stepstone.operators.recommend import fold_decisions

    log = src.decisions(spark, sf_dir)
    state = src.written(spark, sf_dir, "learner_state", lambda: fold_decisions(log))
    _, kept = published(spark, sf_dir)
    linked = graph.endpoints(graph.links(kept))
    current = (
        log.join(linked, F.col("topic_id") == F.col("id"), "left_semi")
        .groupBy("learner").agg(F.max_by("topic_id", "event_id").alias("id"))
    )
    return state.where("decision = 'mastered'").select("learner", "topic_id"), current


@query(
    "g10_nearest_unmastered",
    with_views("pub_edges", "mastered") + CURRENT_SQL + """,
back(learner, node, depth) AS (SELECT learner, id, 0 FROM here UNION
  SELECT b.learner, e.prerequisite_id, b.depth + 1 FROM back b JOIN pub_edges e ON e.topic_id = b.node WHERE b.depth < 40),
ahead(learner, node, depth) AS (SELECT learner, id, 0 FROM here UNION
  SELECT b.learner, e.topic_id, b.depth + 1 FROM ahead b JOIN pub_edges e ON e.prerequisite_id = b.node WHERE b.depth < 40),
cand AS (SELECT learner, node, min(depth) AS depth, 0 AS pass, 'prerequisite' AS direction FROM back WHERE depth > 0 GROUP BY 1, 2
  UNION ALL SELECT learner, node, min(depth), 1, 'dependent' FROM ahead WHERE depth > 0 GROUP BY 1, 2),
open AS (SELECT c.*, row_number() OVER (PARTITION BY c.learner ORDER BY pass, depth, t.age_start, t.name, t.id) AS rn
  FROM cand c JOIN pub_topics t ON t.id = c.node JOIN here h ON h.learner = c.learner AND h.id <> c.node
  WHERE NOT EXISTS (SELECT 1 FROM mastered m WHERE m.learner = c.learner AND m.topic_id = c.node))
SELECT learner, node AS next_id, direction FROM open WHERE rn = 1""",
)
def nearest_unmastered(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, kept = published(spark, sf_dir)
    mastered, current = learner_state(spark, sf_dir)
    return graph.nearest_unmastered(
        current,
        mastered.withColumnRenamed("topic_id", "id"),
        graph.links(kept),
        nodes.select("id", F.col("age_start").alias("age"), "name"),
    )


@query(
    "g11_pair_reachability",
    with_views("edges") + REACH.format(edges="edges")
    + """
SELECT l.d AS src, l.s AS dst, EXISTS (SELECT 1 FROM reach r WHERE r.s = l.d AND r.d = l.s) AS reachable FROM links l""",
)
def pair_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = graph.links(src.edges(spark, sf_dir))
    return reachability.reachable_pairs(graph.reverse(pairs), pairs)


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposed edges: split children inherit the parent's links; some links come turned round, some
    close a two-step path, some name a topic nobody knows."""
    edges = src.edges(spark, sf_dir).select("topic_id", "prerequisite_id", (F.col("t_num") + F.col("p_num")).alias("n"))
    child = src.topics(spark, sf_dir).where("split_from IS NOT NULL").select(F.col("id").alias("child"), "split_from")
    up = edges.join(child, F.col("split_from") == F.col("topic_id")).select(F.col("child").alias("topic_id"), "prerequisite_id")
    down = edges.join(child, F.col("split_from") == F.col("prerequisite_id")).select("topic_id", F.col("child").alias("prerequisite_id"))
    turned = edges.where("n % 5 = 0").select(F.col("prerequisite_id").alias("topic_id"), F.col("topic_id").alias("prerequisite_id"))
    unknown = edges.where("n % 19 = 0").select("topic_id", F.concat("prerequisite_id", F.lit("_gone")).alias("prerequisite_id"))
    first, second = edges.alias("a"), edges.alias("b")
    back = first.join(second, F.col("a.topic_id") == F.col("b.prerequisite_id")).where("(a.n + b.n) % 3 = 0").select(
        F.col("a.prerequisite_id").alias("topic_id"), F.col("b.topic_id").alias("prerequisite_id")
    )
    rows = up.union(down).union(turned).union(unknown).union(back).distinct()
    return rows.withColumns({"strength": F.lit("soft"), "reason": F.lit("proposed")})


@query("g12_safe_append")
def safe_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = broken_cycles(spark, sf_dir)
    return cycles.safe_append(kept, proposals(spark, sf_dir), src.topics(spark, sf_dir), "batch-1").select(
        "topic_id", "prerequisite_id", "verdict", "rejected_reason", "age_regression"
    )


@query("a9_removed_by_reason")
def removed_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_cycles(spark, sf_dir)[1].groupBy("removed_reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query(
    "a8_antiparallel_pairs",
    with_views("edges")
    + " SELECT count(*) AS antiparallel_pairs FROM edges a JOIN edges b ON a.topic_id = b.prerequisite_id AND a.prerequisite_id = b.topic_id WHERE a.topic_id < a.prerequisite_id",
)
def antiparallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.antiparallel_pairs(src.edges(spark, sf_dir))


@query(
    "a10_centrality_distribution",
    with_views("pub_edges") + CENTRALITY + """,
v AS (SELECT centrality, row_number() OVER (ORDER BY centrality DESC) - 1 AS i, count(*) OVER () AS n FROM central WHERE centrality IS NOT NULL)
SELECT max(n) AS nodes, max(centrality) AS max_centrality, round(count(*) FILTER (WHERE centrality > 0)::DOUBLE / max(n), 6) AS nonzero_share,
  max(centrality) FILTER (WHERE i = floor(n * 0.5)) AS p50, max(centrality) FILTER (WHERE i = floor(n * 0.1)) AS p90,
  round(avg(centrality) FILTER (WHERE i < greatest(floor(n * 0.1), 1)), 6) AS top_decile_mean FROM v""",
)
def centrality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.centrality_distribution(published_centrality(spark, sf_dir))
