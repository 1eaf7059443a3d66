"""Scoring queries. Three neighbouring rows count as one event, so the factors of the score are checked without
the grouping itself."""

from pyspark.sql import functions as F

from briefwright.functions import text as T
from briefwright.lexicon import Lexicon
from briefwright.operators import events as E, relevance as V, scoring as S
from briefwright.operators.ranking import ranked
from briefwright.policy import DIMENSIONS, policy
from briefwright.session import cut_lineage
from catalog.base import TEXT, any_of, common, hits, host, items, parts, query, s, table, with_items, words
from catalog.filters import KINDS, LOW, RELEVANT
from catalog.joins import REG, tier_sql, weight_sql
from catalog.scalars import CAMP, EVENT_KEY, KEYS, PAPER, release_sql

L = Lexicon()
c = F.col
K = policy("ranking", {"topic_weights": {"AI Models & Agent": 1.4, "Social & Community": 0.5}})
RANKING = {"topic_weights": {"AI Models & Agent": 1.4, "Social & Community": 0.5}}

# --- topics -----------------------------------------------------------------------------------------------

WORDS2 = "list_distinct(regexp_extract_all(search, '([a-zA-Z][a-zA-Z0-9_+.-]{1,}|[一-鿿]{2,})', 1))"


def score_case(topic):
    from briefwright.lexicons import TOPIC_KEYWORDS

    terms = TOPIC_KEYWORDS[topic]
    out = f"CASE WHEN home = '{topic}' THEN 0.45::DOUBLE ELSE 0.0 END"
    if topic == "Research Papers":
        out += " + CASE WHEN arxiv_id IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0 END"
    out += f" + least(0.45::DOUBLE, len(list_intersect({LOW}, {s(terms)})) * 0.18::DOUBLE) + least(0.55::DOUBLE, {common('w2', terms)} * 0.08::DOUBLE)"
    if topic == "Videos & Podcasts":
        out += f" + CASE WHEN source IN {tuple(V.MEDIA_TOPIC_SOURCES)} THEN 0.35::DOUBLE ELSE 0.0 END"
    if topic == "Books & Reading":
        out += f" + CASE WHEN source IN {tuple(V.BOOK_SOURCES)} THEN 0.5::DOUBLE ELSE 0.0 END"
    return out


HOME = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in V.SOURCE_TOPIC.items()) + "}[source]"
VOTES = ("votes AS MATERIALIZED (SELECT *, [" + ", ".join(f"{{'s': {score_case(t)}, 'o': {-i}, 't': '{t}'}}" for i, t in enumerate(V.TOPICS))
         + f"] AS votes FROM (SELECT *, {HOME} AS home, {WORDS2} AS w2 FROM counted))")


@query("sr03_keyword_topic_scores", with_items("SELECT item_id, " + ", ".join(f"round(votes[{i + 1}].s, 6) AS t{i}" for i in range(len(V.TOPICS))) + " FROM votes", RELEVANT, VOTES))
def topic_scores(spark, sf):
    rows = V.with_routing_text(items(spark, sf)).select("item_id", V.topic_scores(L).alias("v"))
    return rows.select("item_id", *[F.round(c("v")[i]["score"], 6).alias(f"t{i}") for i in range(len(V.TOPICS))])


def topic_sql():
    body = "lower(title || ' ' || content)"
    uncertain = policy("topic_classifier")["uncertain_sources"]
    return f"""topics AS MATERIALIZED (SELECT *, CASE WHEN {any_of('search', V.SKILL_MARKERS)} AND {any_of('search', V.SERVICE_MARKERS)} THEN 'Developer Tools' WHEN on_route THEN 'AI Models & Agent'
      WHEN source = 'hackernews' AND list_contains({LOW}, 'infra') THEN 'Infrastructure & Systems' WHEN source = 'hackernews' AND list_contains({LOW}, 'ai') THEN 'AI Models & Agent'
      WHEN source IN {tuple(uncertain)} AND best.s >= 0.75 AND best.s - second >= 0.12 THEN best.t WHEN arxiv_id IS NOT NULL THEN 'Research Papers'
      WHEN coalesce(home, 'Social & Community') = 'Social & Community' AND {any_of(body, V.MODEL_MARKERS)} THEN 'AI Models & Agent' ELSE coalesce(home, 'Social & Community') END AS topic
      FROM (SELECT *, list_reverse_sort(votes)[1] AS best, list_reverse_sort(votes)[2].s AS second FROM votes))"""


@query("sr04_topic_decision", with_items("SELECT item_id, topic FROM topics", RELEVANT, VOTES, topic_sql()))
def topic_decision(spark, sf):
    return V.with_topic(items(spark, sf), L).select("item_id", c("topic_info.topic").alias("topic"))


@query("ux02_external_decision_hook", with_items("SELECT item_id, CASE WHEN item_id % 5 = 0 THEN 'Books & Reading' ELSE topic END AS topic FROM topics", RELEVANT, VOTES, topic_sql()))
def override(spark, sf):
    from briefwright.operators.joins import with_hash

    rows = V.with_topic(items(spark, sf), L).withColumn("content_hash", c("item_id").cast("string"))
    given = table(spark, sf, "documents").where("doc_id % 5 = 0").select(c("doc_id").cast("string").alias("content_hash"), F.lit("Books & Reading").alias("topic"), F.lit(0.9).alias("confidence"), F.lit("external").alias("method"), F.lit("given").alias("reason"))
    return V.with_override(rows, given).select("item_id", c("topic_info.topic").alias("topic"))


# --- signals ----------------------------------------------------------------------------------------------

LOGS = "log10(greatest(1.0::DOUBLE, score))"
MONEY = r"(?i)(?:[$€£¥]\s?\d+(?:\.\d+)?\s?(?:b|bn|billion|m|mn|million|t|trillion)?)|(?:\b\d+(?:\.\d+)?\s?(?:billion|million|trillion|bn|mn|%|x)(?:[^\p{L}\p{N}_]|$))"
COUNTS = {"n_role": "media_role", "n_knowledge": "media_knowledge", "n_learning": "generic_learning", "n_evidence": "hard_evidence", "n_einfra": "hard_evidence_infra", "n_cloud": "event_cloud", "n_capital": "event_capital",
          "n_infra": "event_infra", "n_open": "event_open_model", "n_cap": "event_capability", "n_ship": "event_ship", "n_filing": "event_filing", "n_comm": "commentary", "n_practice": "community_practice"}
FACTS = [*L["event_cloud"], *L["event_capital"], *L["event_infra"], *L["event_open_model"]]
FEATURES = (release_sql() + f", feats AS MATERIALIZED (SELECT *, {TEXT} AS txt, {words(TEXT, L['stopwords'])} AS toks, {host('url')} AS h, {tier_sql('source', 'url')} AS tier0, {tier_sql('NULL::VARCHAR', 'url')} AS ltier, {weight_sql('source', 'url')} AS w,"
            f" {any_of('lower(concat_ws(chr(32), array_to_string(tags, chr(32)), content))', ['oral', 'best paper', 'outstanding paper', 'distinguished paper', 'award', 'plenary'])} AS oral FROM releases),"
            f" sig0 AS MATERIALIZED (SELECT *, CASE WHEN (source = 'openreview' OR h = 'openreview.net') AND oral THEN 'T1' ELSE tier0 END AS tier, {common('toks', L['media_actor'])} AS n_actor, {hits('txt', FACTS)} AS n_facts, "
            + ", ".join(f"{hits('txt', L[g])} AS {n}" for n, g in COUNTS.items())
            + f", CASE WHEN regexp_matches(txt, '{MONEY}') THEN 1 ELSE 0 END AS money, CASE WHEN regexp_matches(txt, '(?i)\\b\\d+(?:\\.\\d+)?\\s?(?:gw|gigawatt|mw|megawatt)(?:[^\\p{{L}}\\p{{N}}_]|$)') THEN 1 ELSE 0 END AS power,"
            f" source IN {tuple(S.MEDIA_SOURCES)} OR h IN {tuple(S.MEDIA_HOSTS)} AS media, source IN {tuple(S.COMMUNITY_SOURCES)} OR h IN {tuple(S.COMMUNITY_HOSTS)} AS community,"
            f" source IN {tuple(S.EVIDENCE_SOURCES)} OR h IN {tuple(S.EVIDENCE_HOSTS)} OR ltier = 'T1' AS evid FROM feats),"
            f""" sig1 AS (SELECT *, CASE WHEN media AND (n_actor > 0 OR n_role > 0 OR n_knowledge >= 2) THEN least(4.5::DOUBLE, n_actor * 0.55::DOUBLE + n_role * 0.75::DOUBLE + n_knowledge * 0.42::DOUBLE + least(1.5::DOUBLE, {LOGS} * 0.35::DOUBLE)) ELSE 0.0::DOUBLE END AS s_media,
            CASE WHEN media AND n_learning > 0 THEN least(4.0::DOUBLE, n_learning * 0.9::DOUBLE) ELSE 0.0::DOUBLE END AS s_learning,
            CASE WHEN evid AND ((n_cloud >= 2 AND {any_of('txt', S.CLOUD_ANCHORS)}) OR (n_capital >= 1 AND (money > 0 OR {any_of('txt', S.CAPITAL_ANCHORS)})) OR (n_infra >= 2 AND (power > 0 OR {any_of('txt', S.INFRA_ANCHORS)}))
              OR (n_open >= 2 AND {any_of('txt', S.OPEN_MODEL_ANCHORS)}) OR (n_filing >= 2 AND {any_of('txt', S.FILING_ACTORS)}) OR (n_cap >= 3 AND n_ship >= 1 AND {any_of('txt', S.CAPABILITY_ACTORS)} AND {any_of('txt', S.CAPABILITY_ANCHORS)}))
              THEN least(8.5::DOUBLE, CASE tier WHEN 'T1' THEN 1.4::DOUBLE WHEN 'T1.5' THEN 0.8::DOUBLE ELSE 0.4::DOUBLE END + least(3::DOUBLE, n_cloud * 0.45::DOUBLE) + least(3::DOUBLE, n_capital * 0.55::DOUBLE) + least(3::DOUBLE, n_infra * 0.45::DOUBLE)
                + least(2.4::DOUBLE, n_open * 0.5::DOUBLE) + least(3.2::DOUBLE, n_cap * 0.55::DOUBLE + n_ship * 0.25::DOUBLE) + least(2.4::DOUBLE, n_filing * 0.7::DOUBLE) + money * 1.8::DOUBLE + power * 1.8::DOUBLE) ELSE 0.0::DOUBLE END AS s_official,
            CASE WHEN evid AND n_evidence > 0 AND n_einfra > 0 THEN least(6::DOUBLE, n_evidence * 0.75::DOUBLE + n_einfra * 0.35::DOUBLE + money * 1.7::DOUBLE + CASE WHEN ltier = 'T1' OR source = 'finance' THEN 1.1::DOUBLE ELSE 0.5::DOUBLE END + least(1::DOUBLE, {LOGS} * 0.22::DOUBLE)) ELSE 0.0::DOUBLE END AS s_evidence,
            CASE WHEN community AND n_practice > 0 THEN least(4::DOUBLE, n_practice * 0.65::DOUBLE + CASE WHEN source IN ('reddit', 'hackernews', 'hn') THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END + least(2::DOUBLE, {LOGS} * 0.55::DOUBLE)) ELSE 0.0::DOUBLE END AS s_practice FROM sig0),
            sig AS MATERIALIZED (SELECT *, CASE WHEN (media OR community) AND n_comm > 0 AND NOT (n_facts >= 4 AND s_media >= 3) THEN least(4::DOUBLE, n_comm * 0.7::DOUBLE + greatest(0, 2 - n_facts) * 0.4::DOUBLE) ELSE 0.0::DOUBLE END AS s_commentary FROM sig1)""")


def signals(spark, sf):
    rows = S.with_features(items(spark, sf), L, REG)
    return S.with_item_signals(rows, L, RANKING, REG)


for _name, _column in (("sr07_expert_media_signal", "s_media"), ("sr08_generic_learning_signal", "s_learning"), ("sr09_official_hard_event_signal", "s_official"),
                       ("sr10_hard_evidence_signal", "s_evidence"), ("sr11_secondary_commentary_signal", "s_commentary"), ("sr12_community_practice_signal", "s_practice")):
    def _signal(spark, sf, column=_column):
        return signals(spark, sf).select("item_id", F.round(column, 6).alias("signal"))

    query(_name, with_items(f"SELECT item_id, round({_column}, 6) AS signal FROM sig", FEATURES))(_signal)


@query("sr13_architecture_release_signal", with_items(f"""SELECT item_id, CASE WHEN kind IN ('major', 'prerelease') AND n > 0 AND NOT (kind = 'prerelease' AND n < 2 AND NOT b) THEN round(least(10::DOUBLE, n * 1.35::DOUBLE + CASE WHEN kind = 'major' THEN 1.4::DOUBLE ELSE 0.6::DOUBLE END + CASE WHEN b THEN 1.0 ELSE 0.0 END), 2) ELSE 0.0 END AS signal
    FROM (SELECT item_id, kind, {hits('t', L['architecture_release'])} AS n, {any_of('t', ['breaking', 'migration guide', 'backward incompatible'])} AS b FROM (SELECT *, {TEXT} AS t FROM kinds)) WHERE kind IS NOT NULL""", KINDS))
def architecture(spark, sf):
    rows = signals(spark, sf).withColumns({"_run": F.lit(""), "event": c("item_id"), "rank": c("item_id")})
    events = S.with_dimensions(S.event_aggregates(cut_lineage(rows), "event", RANKING), L, RANKING)
    return events.where("release_kind is not null").select(c("event").alias("item_id"), c("architecture_signal").alias("signal"))


@query("sr14_frontier_release_event", with_items(f"""SELECT item_id // 3 AS event, bool_or(release_id <> '') AND (bool_or(release_id <> '' AND {any_of('txt', L['major_release'])}) OR bool_or((source IN {tuple(S.OFFICIAL_SOURCES)} OR h IN {tuple(S.OFFICIAL_HOSTS)}) AND ({common('toks', S.RELEASE_WORDS)} > 0
    OR {any_of('txt', ['available today', 'same price'])}))) AS frontier FROM sig GROUP BY 1""", FEATURES))
def frontier(spark, sf):
    rows = signals(spark, sf).withColumns({"event": F.expr("item_id div 3"), "rank": c("item_id")})
    return S.with_dimensions(S.event_aggregates(cut_lineage(rows), "event", RANKING), L, RANKING).select("event", c("frontier_release").alias("frontier"))


SUBTYPE = f"""CASE WHEN {hits('txt', L['correction'])} > 0 AND {any_of('txt', S.CORRECTION_ANCHORS)} THEN 'correction' WHEN {hits('txt', L['industrial_practice'])} >= 2 AND {any_of('txt', S.PRODUCTION_ANCHORS)} THEN 'production' WHEN {any_of('txt', L['survey'])} THEN 'survey'
    WHEN {any_of('txt', L['position'])} THEN 'position' WHEN {any_of('txt', L['benchmark'])} THEN 'benchmark' WHEN {any_of('txt', S.REPLICATION_ANCHORS)} THEN 'replication' ELSE 'original' END"""


@query("sr15_paper_subtype", with_items(f"SELECT item_id, {SUBTYPE} AS subtype FROM (SELECT item_id, {TEXT} AS txt FROM items)"))
def subtype(spark, sf):
    rows = items(spark, sf).withColumn("text", T.item_text(c("source"), c("title"), c("content"), c("tags"), c("author")))
    return rows.select("item_id", S.text_subtype(c("text"), L).alias("subtype"))


@query("sr17_tier_and_weight_overrides", with_items(f"SELECT item_id, CASE WHEN (source = 'openreview' OR h = 'openreview.net') AND oral THEN 'T1' ELSE tier0 END AS tier, w AS weight FROM feats", FEATURES.split(", sig0 AS")[0]))
def tiers(spark, sf):
    from briefwright.operators.registry import item_tier, item_weight

    rows = items(spark, sf)
    return rows.select("item_id", item_tier(REG, c("source"), c("url"), c("content"), c("tags"), c("extra")).alias("tier"), item_weight(REG, c("source"), c("url")).alias("weight"))


@query("sr21_route_event", with_items("SELECT item_id // 3 AS event, bool_or(on_route) AS on_route FROM counted GROUP BY 1", RELEVANT))
def route_event(spark, sf):
    rows = S.with_features(items(spark, sf), L, REG)
    return rows.groupBy(F.expr("item_id div 3").alias("event")).agg(F.bool_or("on_route").alias("on_route"))


@query("ag19_paper_influence", with_items("SELECT item_id // 3 AS event, round(least(10::DOUBLE, log10(greatest(1::DOUBLE, max(greatest(score, CAST(x_likes AS DOUBLE), x_stars * 1.2::DOUBLE)))) * 2.2::DOUBLE), 2) AS influence FROM items GROUP BY 1"))
def influence(spark, sf):
    events = signals(spark, sf).groupBy(F.expr("item_id div 3").alias("event")).agg(F.max("influence_value").alias("v"))
    return events.select("event", F.round(F.least(F.lit(10.0), F.log10(F.greatest(F.lit(1.0), "v")) * 2.2), 2).alias("influence"))


# --- dimensions and score ---------------------------------------------------------------------------------

from catalog.aggregates import identity_sql  # noqa: E402

UNION_TOKENS = {"technical": "technical", "product": "product", "business": "business", "novelty": "novelty", "reader": "reader_relevance"}
EVENTS = (f"members AS (SELECT *, item_id // 3 AS event, lower({identity_sql()}) AS ident, x_stars AS st FROM sig), "
          "heats AS (SELECT *, CASE WHEN source = 'github' AND url <> '' AND NOT contains(url, '/releases/') AND (CASE WHEN x_stars <> 0 THEN x_stars ELSE score END) >= 20000 THEN least(score, 5000::DOUBLE) ELSE score END AS heat FROM members), "
          "ev0 AS MATERIALIZED (SELECT event, count(*) AS n, least(12, count(DISTINCT ident)) AS div, max(heat) AS heat, flatten(list(toks)) AS toks, string_agg(txt, ' ~ ') AS txt, "
          "round(least(10::DOUBLE, sum(s_media)), 2) AS media, round(least(10::DOUBLE, sum(s_learning)), 2) AS learning, round(least(10::DOUBLE, sum(s_official)), 2) AS official, round(least(10::DOUBLE, sum(s_practice)), 2) AS practice, "
          "round(least(10::DOUBLE, sum(s_commentary)), 2) AS commentary, round(least(10::DOUBLE, greatest(sum(s_evidence), round(least(10::DOUBLE, sum(s_official)), 2))), 2) AS evidence FROM heats GROUP BY event)")


@query("sr05_event_signals", with_items("SELECT event, n, div, heat, media, learning, practice, commentary FROM ev0", FEATURES, EVENTS))
def event_signals(spark, sf):
    rows = signals(spark, sf).withColumns({"event": F.expr("item_id div 3"), "rank": c("item_id")})
    return S.event_aggregates(cut_lineage(rows), "event", RANKING).select("event", c("cluster_size").alias("n"), c("diversity").alias("div"), c("heat_value").alias("heat"), c("media_signal").alias("media"),
                                                             c("learning_signal").alias("learning"), c("practice_signal").alias("practice"), c("commentary_signal").alias("commentary"))


def scored(spark, sf):
    rows = S.with_features(items(spark, sf), L, REG).withColumns({"_run": F.lit(""), "event": F.expr("item_id div 3"), "rank": c("item_id")})
    return E.score_events(rows, L, RANKING, REG)


@query("sr05_dimension_scores")
def dimensions(spark, sf):
    return scored(spark, sf).select("event", *[c(f"dimensions.{d}").alias(d) for d in DIMENSIONS])


EXTERNAL = ", ".join(f"CASE WHEN doc_id % 3 = 0 THEN round(least(10::DOUBLE, greatest(0::DOUBLE, (doc_id % 17 - {k}) * 1.5::DOUBLE)), 2) ELSE -1.0 END AS {d}" for k, d in enumerate(DIMENSIONS))


@query("sr06_external_dimension_check", f"SELECT doc_id, {EXTERNAL} FROM documents")
def external(spark, sf):
    """A third of the documents has all dimensions, some below 0 or above 10; a third lacks some, a third has none: both fall back."""
    doc = F.to_json(F.struct(*[((c("doc_id") % 17 - k) * 1.5).alias(d) for k, d in enumerate(DIMENSIONS)]))
    raw = F.when(c("doc_id") % 3 == 0, doc).when(c("doc_id") % 3 == 1, '{"novelty": 4}')
    fallback = F.struct(*[F.lit(-1.0).alias(d) for d in DIMENSIONS])
    checked = table(spark, sf, "documents").select("doc_id", S.checked_dimensions(raw, fallback).alias("d"))
    return checked.select("doc_id", *[c(f"d.{d}").alias(d) for d in DIMENSIONS])


@query("sr16_paper_quality")
def paper(spark, sf):
    return scored(spark, sf).where("paper is not null").select("event", "paper.subtype", "paper.quality", "paper.multiplier")


@query("sr18_rank_multipliers", with_items("""SELECT event, round(1.0::DOUBLE + least(0.45::DOUBLE, greatest(0, div - 1) * 0.1::DOUBLE), 4) AS cross_source, round(1.0::DOUBLE + least(0.25::DOUBLE, greatest(0, n - 1) * 0.04::DOUBLE), 4) AS size,
    CASE WHEN learning > 0 AND media < 3 THEN 0.62::DOUBLE ELSE 1.0::DOUBLE END AS learning, CASE WHEN commentary > 0 AND official = 0 THEN 0.68::DOUBLE ELSE 1.0::DOUBLE END AS commentary FROM ev0""", FEATURES, EVENTS))
def multipliers(spark, sf):
    b = lambda k: c(f"breakdown.{k}_multiplier")
    return scored(spark, sf).select("event", b("cross_source").alias("cross_source"), b("cluster_size").alias("size"), b("generic_learning").alias("learning"), b("secondary_commentary").alias("commentary"))


@query("sr19_event_score")
def event_score(spark, sf):
    return scored(spark, sf).select("event", "category", "event_score", "breakdown.base_score")


@query("ux03_policy_config", with_items("SELECT route, count(*) AS n FROM (SELECT CASE WHEN route = 'investment' THEN route WHEN relevance >= 0.5 THEN 'kept' ELSE 'filtered' END AS route FROM routed) GROUP BY route", RELEVANT))
def policies(spark, sf):
    return V.with_relevance(items(spark, sf), L, {"min_score": "0.5", "unknown": 1}).groupBy("route").agg(F.count(F.lit(1)).alias("n"))
