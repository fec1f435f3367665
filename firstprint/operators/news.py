"""Story counts, loudness, notable stories and entity matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from firstprint.functions.periods import week_ending_sunday
from firstprint.functions.staging import once


def weekly_distinct_counts(df: DataFrame, date: str, query: str, story: str,
                           queries: list[str], through=None) -> DataFrame:
    """Distinct stories per week, per search and in total, silent weeks as zero.

    A first aggregate keeps one row per (week, story) with a mark per search,
    so neither a hot week nor a much-copied story is gathered anywhere.
    """
    week = week_ending_sunday(date)
    marks = [F.max(F.when(F.col(query) == q, 1).otherwise(0)).alias(f"_q{i}")
             for i, q in enumerate(queries)]
    stories = (df.where(F.col(date).isNotNull())
               .groupBy(week.alias("week_ending"), F.col(story)).agg(*marks))
    counted = stories.groupBy("week_ending").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.sum(f"_q{i}").alias(q) for i, q in enumerate(queries)])
    last = F.max("week_ending")
    if through is not None:
        last = F.greatest(last, week_ending_sunday(F.lit(through).cast("date")))
    spine = (counted.agg(F.min("week_ending").alias("a"), last.alias("b")).where(F.col("a").isNotNull())
             .select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("week_ending")))
    return spine.join(counted, "week_ending", "left").fillna(0, ["total", *queries])


def long_counts(weeks: DataFrame, queries: list[str]) -> DataFrame:
    """Weekly counts with one row per (week, search), the total included."""
    return weeks.unpivot(["week_ending"], ["total", *queries], "search", "n")


def loudness_band(counts: DataFrame, key: list[str], week: str, count: str,
                  bands: list[tuple[float | None, str]], baseline_weeks: int = 12,
                  min_weeks: int = 4, normal: str = "about normal") -> DataFrame:
    """Each week against the median of up to `baseline_weeks` weeks before it.

    No band until `min_weeks` earlier weeks exist. A zero baseline gives the top
    band when anything was published and the normal one when nothing was.
    """
    past = Window.partitionBy(*key).orderBy(week).rowsBetween(-baseline_weeks, -1)
    enough = F.col("weeks_before") >= min_weeks
    base = F.expr(f"percentile({count}, 0.5)").over(past)
    ratio = F.try_divide(F.col(count), F.col("baseline"))
    top = next(label for below, label in bands if below is None)
    label = F.lit(normal)
    for below, name in reversed(bands):
        label = F.lit(name) if below is None else F.when(F.col("ratio") < below, name).otherwise(label)
    silent = (F.col("baseline") == 0) & (F.col(count) == 0)
    return (counts.withColumn("weeks_before", F.count(F.lit(1)).over(past))
            .withColumn("baseline", F.when(enough, base)).withColumn("ratio", ratio)
            .withColumn("label", F.when(~enough, "building a baseline").when(silent, normal)
                        .when(F.col("baseline") == 0, top).otherwise(label)))


def notable(df: DataFrame, date: str, story: str, since, extreme: str, banks: str,
            arrival: str, columns: list[str]) -> DataFrame:
    """First row of each story since a day; record wording, then banks, then newest."""
    fields = list(dict.fromkeys([date, extreme, banks, *columns]))
    first = (df.where(F.col(date) >= since).groupBy(story)
             .agg(F.min_by(F.struct(*fields), arrival).alias("_f"), F.min(arrival).alias(arrival))
             .select(story, arrival, "_f.*"))
    return first.orderBy(F.col(extreme) != "yes", F.col(banks) == "", F.desc(date), arrival)


# --- Entities named in headlines ------------------------------------------------

# Names that travel whole to every task: at most so many rows, and so many bytes of names and entities.
AUTOMATON_ROWS = 200_000
AUTOMATON_BYTES = 16 << 20

_ATOM = r"[a-z0-9]+|[^a-z0-9\s]"


def _atoms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_ATOM), F.lit(0))


def phrase_entity_match(headlines: DataFrame, story: str, title: str, entities: DataFrame,
                        entity: str, phrase: str, most_rows: int = AUTOMATON_ROWS,
                        most_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """(story, entity) pairs where a name stands in the title as a whole word, in either case.

    Counting the names is a small job while planning. As long as they fit the
    two bounds they are sent to every task as one automaton, which reads each
    title once for all names together; a larger set of names is joined
    (`phrase_entity_join`). Both give the same rows: one per (story, entity).
    Null titles, null entities and names without a visible character match nothing.
    """
    names = (entities.select(F.col(entity).alias("entity"), F.col(phrase).cast("string").alias("phrase"))
             .where(F.col("entity").isNotNull() & F.rlike("phrase", F.lit(r"\S"))).distinct())
    size = names.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(
        F.octet_length("phrase") + F.octet_length(F.col("entity").cast("string"))), F.lit(0)).alias("bytes")).first()
    if size["n"] > most_rows or size["bytes"] > most_bytes:
        return phrase_entity_join(headlines, story, title, names.withColumnsRenamed({"entity": entity, "phrase": phrase}),
                                  entity, phrase)
    known = headlines.sparkSession.sparkContext.broadcast([tuple(r) for r in names.collect()])
    schema = T.StructType([headlines.schema[story], T.StructField(entity, entities.schema[entity].dataType)])
    found = headlines.select(story, F.col(title).cast("string")).mapInArrow(_reader(known, schema), schema)
    return found.distinct()


def folded(text: str) -> str:
    """Lower case with one character for one, so places in the text stay where they are."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(l if len(l := c.lower()) == 1 else c for c in text)


_WORD_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def _automaton(names: list[tuple]):
    """All names in one automaton; each end state knows its length and the entities so called."""
    import ahocorasick

    called: dict[str, set] = {}
    for owner, name in names:
        called.setdefault(folded(name), set()).add(owner)
    automaton = ahocorasick.Automaton()
    for place, (name, owners) in enumerate(called.items()):
        automaton.add_word(name, (place, len(name), tuple(owners)))
    automaton.make_automaton()
    return automaton


def entities_in(text: str, automaton) -> set:
    """The entities whose names stand in the text as whole words."""
    text, out, done = folded(text), set(), set()
    for end, (place, length, owners) in automaton.iter(text):
        if place in done:
            continue
        start = end - length + 1
        if (start and text[start - 1] in _WORD_SIGNS) or (end + 1 < len(text) and text[end + 1] in _WORD_SIGNS):
            continue
        done.add(place)
        out.update(owners)
    return out


def _reader(known, schema: T.StructType):
    """The task's side: the automaton is built once a task and reads batch after batch."""
    def read(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target, automaton = to_arrow_schema(schema), _automaton(known.value)
        for batch in batches:
            rows, owners = [], []
            for row, text in enumerate(batch.column(1) if len(automaton) else ()):
                for owner in entities_in(text.as_py(), automaton) if text.is_valid else ():
                    rows.append(row)
                    owners.append(owner)
            stories = batch.column(0).take(pa.array(rows, pa.int64())).cast(target.field(0).type)
            yield pa.RecordBatch.from_arrays([stories, pa.array(owners, target.field(1).type)], schema=target)
    return read


def phrase_entity_join(headlines: DataFrame, story: str, title: str, entities: DataFrame,
                       entity: str, phrase: str) -> DataFrame:
    """The same pairs for any number of names, as a join.

    Titles and names are cut into words and single signs. A name is keyed by
    its first two of them (or its only one), so finding candidates is an
    equality join on keys; only keys travel, not texts. Each candidate is then
    confirmed by the whole-word test on the full title.
    """
    pair = lambda a, b: F.concat_ws("\u0001", a, b)
    names = (once(entities.withColumn("_phrase", F.col(phrase)), [entity, "_phrase"], _a=_atoms(F.col(phrase)))
             .where(F.size("_a") > 0)
             .withColumn("_key", F.when(F.size("_a") == 1, F.col("_a")[0]).otherwise(
                 pair(F.get("_a", F.lit(0)), F.get("_a", F.lit(1))))).drop("_a"))
    cut = once(headlines, [story], _a=_atoms(F.col(title))).where(F.size("_a") > 0)
    pairs = F.zip_with(F.slice("_a", 1, F.size("_a") - 1), F.slice("_a", 2, F.size("_a")), pair)
    keys = cut.select(story, F.explode(F.array_distinct(F.concat("_a", pairs))).alias("_key"))
    candidates = keys.join(names, "_key").select(story, entity, "_phrase").distinct()
    # One run of letters and digits is a whole word wherever its key occurs, so
    # only the other names need the text.
    plain = F.rlike(F.col("_phrase"), F.lit("^[A-Za-z0-9]+$"))
    quoted = F.regexp_replace("_phrase", r"([\\.^$|?*+()\[\]{}\-&#~])", r"\\$1")
    pattern = F.concat(F.lit("(?iu)(?<![A-Za-z0-9])"), quoted, F.lit("(?![A-Za-z0-9])"))
    texts = headlines.select(F.col(story).alias("_story"), F.col(title).alias("_title"))
    checked = candidates.join(texts, (F.col(story) == F.col("_story")) & ~plain, "left")
    return (checked.where(plain | F.coalesce(F.rlike(F.col("_title"), pattern), F.lit(False)))
            .select(story, entity).distinct())


def entity_phrases(entities: DataFrame, entity: str, name: str, aliases: str, symbol: str) -> DataFrame:
    """One row per (entity, phrase): name, aliases, and symbols of three letters up."""
    short = F.when(F.length(symbol) >= 3, F.col(symbol))
    listed = F.array_compact(F.concat(F.array(F.col(name), short),
                                      F.coalesce(F.col(aliases), F.array().cast("array<string>"))))
    return entities.select(entity, F.explode(F.array_distinct(listed)).alias("phrase"))
