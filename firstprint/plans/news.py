"""Stories, tags, loudness and entity matches over the document tables."""

import datetime as dt

from pyspark.sql import Window, functions as F

from firstprint.functions import text as X
from firstprint.operators import filings as FL, news as N
from firstprint.plans.registry import query
from firstprint.plans.tables import HEADLINES, headlines, table
from firstprint.session import spread

SEARCHES = ["lang_en", "lang_fr", "lang_de", "lang_es", "long", "the"]
THROUGH = dt.date(2024, 7, 20)
BANDS = [(0.5, "unusually quiet"), (1.5, "about normal"), (2.5, "louder than usual"), (None, "very loud")]

# The phrase dictionaries of these queries.
TAGS = {"bank": {"alpha": ["the", "of the"], "beta": ["les", "une"], "gamma": ["und", "der"]},
        "direction": {"buying": ["is", "les"], "selling": ["of", "und"]},
        "topic": {"crowding": ["and", "el"], "leverage": ["in", "la"], "short": ["that"]},
        "extreme": ["the", "que"]}
REQUIRED = ["the", "der", "la", "of the"]
EXCLUDED = ["s1", "web"]


def sql_has(column: str, phrases) -> str:
    """Whole-word test for an engine whose patterns cannot look behind."""
    return f"regexp_matches({column}, '(?i)(^|[^A-Za-z0-9])({'|'.join(phrases)})($|[^A-Za-z0-9])')"


def sql_labels(column: str, categories) -> str:
    cases = ", ".join(f"CASE WHEN {sql_has(column, words)} THEN '{label}' END" for label, words in categories.items())
    return f"list_filter([{cases}], lambda q: q IS NOT NULL)"


STORIES = """stories AS (
  SELECT *, substr(sha1(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))), 1, 16) AS story_id
  FROM headlines)"""


def stories(spark, sf):
    return headlines(spark, sf).withColumn("story_id", X.story_key("title"))


COUNTS = "counted AS (SELECT CAST(date_trunc('week', published) AS DATE) + 6 AS week_ending, " + ", ".join(
    ["count(DISTINCT story_id) AS total"]
    + [f"count(DISTINCT story_id) FILTER (query_id = '{q}') AS {q}" for q in SEARCHES]) + """
  FROM stories GROUP BY 1), spine AS (
  SELECT CAST(unnest(generate_series((SELECT min(week_ending) FROM counted),
    greatest((SELECT max(week_ending) FROM counted), DATE '2024-07-21'), INTERVAL 7 DAY)) AS DATE) AS week_ending),
  weeks AS (SELECT s.week_ending, coalesce(total, 0) AS total, """ + ", ".join(
    f"coalesce({q}, 0) AS {q}" for q in SEARCHES) + " FROM spine s LEFT JOIN counted c USING (week_ending))"


def weeks(spark, sf):
    return N.weekly_distinct_counts(stories(spark, sf), "published", "query_id", "story_id", SEARCHES, THROUGH)


@query("weekly_distinct_counts", "week_ending:d total:i " + " ".join(f"{q}:i" for q in SEARCHES),
       HEADLINES, STORIES, COUNTS, "result AS (SELECT * FROM weeks)")
def weekly_distinct_counts(spark, sf):
    return weeks(spark, sf)


@query("loudness_band", "week_ending:d search n:i weeks_before:i baseline:n ratio:n label",
       HEADLINES, STORIES, COUNTS, f"""long_counts AS (
  SELECT * FROM weeks UNPIVOT (n FOR search IN (total, {', '.join(SEARCHES)}))), based AS (
  SELECT a.week_ending, a.search, a.n, count(b.n) AS weeks_before,
         CASE WHEN count(b.n) >= 4 THEN quantile_cont(b.n, 0.5) END AS baseline
  FROM long_counts a LEFT JOIN long_counts b ON a.search = b.search
    AND b.week_ending < a.week_ending AND b.week_ending >= a.week_ending - 84 GROUP BY 1, 2, 3)""", """result AS (
  SELECT *, n / nullif(baseline, 0) AS ratio,
    CASE WHEN weeks_before < 4 THEN 'building a baseline' WHEN baseline = 0 AND n = 0 THEN 'about normal'
         WHEN baseline = 0 THEN 'very loud' WHEN n / baseline < 0.5 THEN 'unusually quiet'
         WHEN n / baseline < 1.5 THEN 'about normal' WHEN n / baseline < 2.5 THEN 'louder than usual'
         ELSE 'very loud' END AS label FROM based)""")
def loudness_band(spark, sf):
    return N.loudness_band(N.long_counts(weeks(spark, sf), SEARCHES), ["search"], "week_ending", "n", BANDS)


# --- Tags ---------------------------------------------------------------------------

@query("multi_label_tags", "doc_id:i banks direction topics extreme", f"""labelled AS (
  SELECT doc_id, array_to_string({sql_labels('text', TAGS['bank'])}, ';') AS banks,
         {sql_labels('text', TAGS['direction'])} AS dirs,
         array_to_string({sql_labels('text', TAGS['topic'])}, ';') AS topics,
         CASE WHEN {sql_has('text', TAGS['extreme'])} THEN 'yes' ELSE '' END AS extreme FROM documents)""",
       """result AS (SELECT *, CASE WHEN len(dirs) = 1 THEN dirs[1] WHEN len(dirs) > 1 THEN 'mixed' ELSE '' END
  AS direction FROM labelled)""")
def multi_label_tags(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", X.headline_tags("text", TAGS).alias("t")).select("doc_id", "t.*")


@query("relevance_filter", "doc_id:i source lang", f"""result AS (
  SELECT doc_id, source, lang FROM documents WHERE source NOT IN ('s1', 'web') AND {sql_has('text', REQUIRED)})""")
def relevance_filter(spark, sf):
    return table(spark, sf, "documents").where(X.is_relevant("text", "source", REQUIRED, EXCLUDED))


# Topic substrings of these queries.
TOPICS = {"results": ["the ", "Der"], "guidance": ["é"], "dividend": ["ü", "ß"], "buyback": ["ING"], "plan": ["qu"]}
PRIORITY = {"en": ["results", "buyback"], "fr": ["guidance"], "de": ["dividend"]}
TOPIC_SQL = ", ".join(
    "CASE WHEN " + " OR ".join(f"contains(text, '{p}')" + (f" OR contains(lower(text), '{p.lower()}')" if p.isascii() else "")
                               for p in pats) + f" THEN '{t}' END" for t, pats in TOPICS.items())


@query("topic_tags", "doc_id:i topics needs_reading", f"""found AS (
  SELECT doc_id, lang, list_filter([{TOPIC_SQL}], lambda q: q IS NOT NULL) AS t FROM documents)""", """result AS (
  SELECT doc_id, array_to_string(t, ';') AS topics, CASE
    WHEN lang = 'en' AND (list_contains(t, 'results') OR list_contains(t, 'buyback')) THEN 'yes'
    WHEN lang = 'fr' AND list_contains(t, 'guidance') THEN 'yes'
    WHEN lang = 'de' AND list_contains(t, 'dividend') THEN 'yes' ELSE '' END AS needs_reading FROM found)""")
def topic_tags(spark, sf):
    lists = F.coalesce(*[F.when(F.col("lang") == lang, F.array(*[F.lit(t) for t in topics]))
                         for lang, topics in PRIORITY.items()], F.array().cast("array<string>"))
    docs = table(spark, sf, "documents").select("doc_id", "lang", X.topic_tags("text", TOPICS).alias("found"))
    return docs.select("doc_id", F.array_join("found", ";").alias("topics"),
                       X.needs_reading("found", lists).alias("needs_reading"))


GLOSSES = [("ß", "sharp s"), ("ü", "u umlaut"), ("ê", "e circumflex"), ("é", "e acute")]


@query("ordered_gloss", "doc_id:i gloss", """titles AS (
  SELECT doc_id, text AS t FROM documents)""", """result AS (
  SELECT doc_id, CASE WHEN regexp_full_match(t, '[\\x00-\\x7F]*') THEN t
    WHEN contains(t, 'ß') THEN 'sharp s (' || t || ')' WHEN contains(t, 'ü') THEN 'u umlaut (' || t || ')'
    WHEN contains(t, 'ê') THEN 'e circumflex (' || t || ')' WHEN contains(t, 'é') THEN 'e acute (' || t || ')'
    ELSE t END AS gloss FROM titles)""")
def ordered_gloss(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.ordered_gloss("text", GLOSSES).alias("gloss"))


@query("story_key", "story_id n:i first_doc:i", """keyed AS (
  SELECT doc_id, substr(sha1(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))), 1, 16) AS story_id
  FROM documents)""", "result AS (SELECT story_id, count(*) AS n, min(doc_id) AS first_doc FROM keyed GROUP BY 1)")
def story_key(spark, sf):
    return (table(spark, sf, "documents").groupBy(X.story_key("text").alias("story_id"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")))


@query("split_suffix", "doc_id:i known_title known_outlet guessed_title guessed_outlet", """titles AS (
  SELECT doc_id, text AS t, source FROM documents)""", """result AS (
  SELECT doc_id, trim(t) AS known_title, source AS known_outlet,
         trim(t || ' - ' || lang_part) AS guessed_title, trim(source) AS guessed_outlet
  FROM (SELECT *, 'desk' AS lang_part FROM titles))""")
def split_suffix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("t"), "source")
    known = X.split_suffix(F.concat_ws(" - ", "t", "source"), F.col("source"))
    guessed = X.split_suffix(F.concat_ws(" - ", "t", F.lit("desk"), "source"), F.lit(""))
    return docs.select("doc_id", known["title"].alias("known_title"), known["outlet"].alias("known_outlet"),
                       guessed["title"].alias("guessed_title"), guessed["outlet"].alias("guessed_outlet"))


@query("clean_text", "page_id:i chars:i digest", """cleaned AS (
  SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
    '&#39;', ''''), '&apos;', ''''), '&pound;', '£'), '&amp;', '&'), '[\\s' || chr(160) || chr(11) || ']+', ' ', 'g')) AS t
  FROM pages)""", "result AS (SELECT page_id, length(t) AS chars, md5(t) AS digest FROM cleaned)")
def clean_text(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", X.clean_text("html").alias("t"))
    return pages.select("page_id", F.length("t").alias("chars"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query("notable", "story_id published:d extreme banks outlet", HEADLINES, STORIES, f"""tagged AS (
  SELECT *, array_to_string({sql_labels('title', TAGS['bank'])}, ';') AS banks,
         CASE WHEN {sql_has('title', TAGS['extreme'])} THEN 'yes' ELSE '' END AS extreme
  FROM stories WHERE published >= DATE '2024-05-01')""", """result AS (
  SELECT story_id, published, extreme, banks, outlet FROM tagged
  QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY doc_id) = 1)""")
def notable(spark, sf):
    rows = stories(spark, sf)
    tags = X.headline_tags("title", TAGS)
    rows = rows.withColumn("banks", tags["banks"]).withColumn("extreme", tags["extreme"])
    return N.notable(rows, "published", "story_id", dt.date(2024, 5, 1), "extreme", "banks", "doc_id", ["outlet"])


@query("distinct_ranked_items", "place:i story_id published:d extreme banks", HEADLINES, STORIES, f"""tagged AS (
  SELECT *, array_to_string({sql_labels('title', TAGS['bank'])}, ';') AS banks,
         CASE WHEN {sql_has('title', TAGS['extreme'])} THEN 'yes' ELSE '' END AS extreme
  FROM stories WHERE published >= DATE '2024-05-01'), firsts AS (
  SELECT * FROM tagged QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY doc_id) = 1)""", """result AS (
  SELECT row_number() OVER (ORDER BY extreme <> 'yes', banks = '', published DESC, doc_id) AS place,
         story_id, published, extreme, banks FROM firsts QUALIFY place <= 12)""")
def distinct_ranked_items(spark, sf):
    top = notable(spark, sf).limit(12)
    place = F.row_number().over(Window.orderBy(F.col("extreme") != "yes", F.col("banks") == "",
                                               F.desc("published"), "doc_id"))
    return top.withColumn("place", place)


# --- Entities named in texts ----------------------------------------------------------

@query("phrase_entity_match", "doc_id:i entity", """names AS (
  SELECT p_name AS entity FROM part UNION SELECT split_part(p_name, ' ', 1) FROM part
  UNION SELECT text FROM benchmark),
  short_names AS (SELECT entity FROM names WHERE length(trim(entity)) > 0)""", """result AS (
  SELECT doc_id, entity FROM documents JOIN short_names ON contains(lower(text), lower(entity))
  WHERE regexp_matches(text, '(?i)(^|[^A-Za-z0-9])' || regexp_escape(entity) || '($|[^A-Za-z0-9])'))""")
def phrase_entity_match(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_name").alias("entity"))
    first = part.select(F.split("entity", " ")[0].alias("entity"))
    bench = table(spark, sf, "benchmark").select(F.col("text").alias("entity"))
    names = part.union(first).union(bench).distinct().withColumn("phrase", F.col("entity"))
    return N.phrase_entity_match(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text", names, "entity", "phrase")


@query("phrase_entity_symbols", "doc_id:i entity", """listed AS (
  SELECT DISTINCT p_name AS entity, split_part(p_name, ' ', 1) AS alias, substr(p_type, 1, 1 + p_size % 4) AS symbol FROM part
  UNION SELECT split_part(text, ' ', 1), array_to_string(string_split(text, ' ')[1:3], ' '), nullif(split_part(text, ' ', 2), '')
  FROM benchmark WHERE text IS NOT NULL), names AS (
  SELECT entity, entity AS phrase FROM listed UNION SELECT entity, alias FROM listed
  UNION SELECT entity, symbol FROM listed WHERE length(symbol) >= 3),
  phrases AS (SELECT DISTINCT phrase FROM names WHERE length(trim(phrase)) > 0), hits AS (
  SELECT doc_id, phrase FROM documents JOIN phrases ON contains(lower(text), lower(phrase))
  WHERE regexp_matches(text, '(?i)(^|[^A-Za-z0-9])' || regexp_escape(phrase) || '($|[^A-Za-z0-9])'))""", """result AS (
  SELECT DISTINCT doc_id, entity FROM hits JOIN names USING (phrase))""")
def phrase_entity_symbols(spark, sf):
    """Entities with a name, an alias and a symbol; symbols under three letters are not looked for."""
    words = F.split("text", " ")
    part = table(spark, sf, "part").select(
        F.col("p_name").alias("entity"), F.array(F.split("p_name", " ")[0]).alias("aliases"),
        F.substring(F.col("p_type"), F.lit(1), 1 + F.col("p_size") % 4).alias("symbol"))
    items = table(spark, sf, "benchmark").where(F.col("text").isNotNull()).select(
        words[0], F.array(F.concat_ws(" ", F.slice(words, 1, 3))), F.get(words, F.lit(1)))
    phrases = N.entity_phrases(part.union(items).distinct(), "entity", "entity", "aliases", "symbol")
    return N.phrase_entity_match(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text", phrases,
                                 "entity", "phrase")


# --- Filings --------------------------------------------------------------------------

@query("entity_any_id", "o_orderkey:i entity_code entity_name topics", """watch AS (
  SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name, 'S' || c_custkey AS id FROM customer
  WHERE c_acctbal > 5000), hits AS (
  SELECT o.*, coalesce(a.code, b.code) AS entity_code, coalesce(a.name, b.name) AS entity_name FROM orders o
  LEFT JOIN watch a ON a.code = CAST(o_custkey AS VARCHAR) LEFT JOIN watch b ON b.id = 'S' || o_orderkey)""",
       """result AS (
  SELECT o_orderkey, entity_code, entity_name, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderstatus || ';ownership'
    WHEN '2-HIGH' THEN o_orderstatus || ';buyback' ELSE o_orderstatus END AS topics
  FROM hits WHERE entity_code IS NOT NULL)""")
def entity_any_id(spark, sf):
    watch = (table(spark, sf, "customer").where("c_acctbal > 5000")
             .select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name"),
                     F.concat(F.lit("S"), "c_custkey").alias("entity_id")))
    kind = F.col("o_orderpriority")
    docs = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("sec"), F.concat(F.lit("S"), "o_orderkey").alias("filer"),
        F.array("o_orderstatus").alias("found"),
        F.when(kind == "1-URGENT", "350").when(kind == "2-HIGH", "220").otherwise("999").alias("doc_type"))
    hits = FL.entity_any_id(docs, "o_orderkey", "sec", ["filer"], watch)
    return hits.withColumn("topics", F.array_join(FL.doc_type_topics(F.col("found"), F.col("doc_type")), ";"))


STAMPS = """stamped AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day,
         o_orderpriority <> '5-LOW' AS readable FROM orders)"""


def stamped(spark, sf):
    """Orders with the date written the way four sources would, one of them unreadable."""
    kind = F.col("o_orderpriority")
    stamp = (F.when(kind == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
             .when(kind == "2-HIGH", F.date_format("o_orderdate", "yyyyMMdd"))
             .when(kind == "5-LOW", "date unknown").otherwise(F.date_format("o_orderdate", "d MMM yyyy, h:mm a")))
    return table(spark, sf, "orders").withColumn("stamp", stamp)


@query("freshness_split", "o_orderpriority age n:i", STAMPS, """result AS (
  SELECT o_orderpriority, CASE WHEN NOT readable OR day >= DATE '2001-07-20' THEN 'news' ELSE 'history' END AS age,
         count(*) AS n FROM stamped GROUP BY 1, 2)""")
def freshness_split(spark, sf):
    age = FL.freshness("stamp", F.lit(dt.date(2001, 7, 30)))
    return stamped(spark, sf).groupBy("o_orderpriority", age.alias("age")).agg(F.count(F.lit(1)).alias("n"))


@query("last_n_vwap", "supplier:i last_trade:d days:i shares:n spend:n avg_pence:n gap_days:i watch:b", """trades AS (
  SELECT l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS day, l_quantity AS shares, l_extendedprice AS pence
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_shipdate DESC, l_quantity DESC, l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC) <= 5), sums AS (
  SELECT supplier, max(day) AS last_trade, count(*) AS days, sum(shares) AS shares,
         sum(shares * pence) / 100.0 AS spend FROM trades GROUP BY 1)""", """result AS (
  SELECT *, spend * 100.0 / nullif(shares, 0) AS avg_pence, g AS gap_days, g >= 3 AS watch FROM (
    SELECT *, (SELECT count(*) FROM (SELECT unnest(generate_series(CAST(last_trade AS TIMESTAMP) + INTERVAL 1 DAY,
      TIMESTAMP '2001-11-06', INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6) AS g FROM sums))""")
def last_n_vwap(spark, sf):
    trades = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("shares"),
        F.col("l_extendedprice").alias("pence"), "l_orderkey", "l_linenumber")
    return FL.last_n_vwap(trades, ["supplier"], "day", "shares", "pence", F.lit(dt.date(2001, 11, 6)),
                          ties=["l_orderkey", "l_linenumber"])


@query("filings_digest", "c_mktsegment n_new:i n_history:i n_must_read:i n_routine:i", STAMPS, """aged AS (
  SELECT s.*, c_mktsegment, NOT readable OR s.day >= DATE '2001-07-20' AS fresh
  FROM stamped s JOIN customer ON o_custkey = c_custkey WHERE s.day >= DATE '2001-06-01')""", """result AS (
  SELECT c_mktsegment, count(*) FILTER (fresh AND o_orderstatus <> 'P') AS n_new,
         count(*) FILTER (NOT fresh AND o_orderstatus <> 'P') AS n_history,
         count(*) FILTER (fresh AND o_orderstatus <> 'P' AND o_totalprice > 300000) AS n_must_read,
         count(*) FILTER (fresh AND o_orderstatus = 'P') AS n_routine FROM aged GROUP BY 1)""")
def filings_digest(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    docs = (stamped(spark, sf).join(customer, "o_custkey")
            .withColumn("reading", F.when(F.col("o_totalprice") > 300000, "yes").otherwise(""))
            .withColumn("routine", F.when(F.col("o_orderstatus") == "P", "yes").otherwise("")))
    return FL.filings_digest(docs, ["c_mktsegment"], "o_orderdate", dt.datetime(2001, 6, 1), "stamp",
                             F.lit(dt.date(2001, 7, 30)), "reading", "routine")


@query("next_events", "o_orderkey:i day:d", """result AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01'
  ORDER BY o_orderdate, o_orderkey LIMIT 4)""")
def next_events(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return FL.next_events(rows, "day", dt.date(2001, 7, 1), 4, ["o_orderkey"])
