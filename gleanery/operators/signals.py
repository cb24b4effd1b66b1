"""Classification signals: which words and files make a project qualitative?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import workers
from gleanery.functions.lists import clean_list
from gleanery.functions.text import clean_text, file_extension, fold, match_form
from gleanery.session import cut_lineage

REASON_TERMS = 10


def term_positions(text: Column, terms: list[str], engine: str = "automaton") -> Column:
    """Positions of the terms a text contains, ascending; plain substring test.

    `automaton` walks each text once in a Python worker; `builtin` tests term
    after term inside the JVM and needs no Python. Both give the same answer.
    """
    low = F.lower(text)
    folded = [t.lower() for t in terms]
    if engine == "automaton":
        return workers.term_finder(folded)(low)
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("t"))
                        for i, t in enumerate(folded)])
    return F.transform(F.filter(entries, lambda e: F.contains(low, e["t"])), lambda e: e["i"])


#: Characters of the pieces by which a dictionary table is searched.
PIECE = 4


def _pieces(text: Column, n: int) -> Column:
    """All different runs of `n` characters of a text; the look-ahead lets them overlap."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def dictionary_hits(texts: DataFrame, key: list[str], text: str, terms: DataFrame, term: str) -> DataFrame:
    """(key, term): which terms of a table of any size each text contains, without case.

    A term can only be in texts that hold all its pieces, so each is filed under
    the one that fewest texts hold; texts meet the terms of their pieces in an
    equi-join and are tested once. Neither table goes through the driver, and no
    text meets a term that it shares no piece with. Terms shorter than a piece
    are filed whole. `key` must tell texts apart; blank terms are none.
    """
    words = terms.select(F.col(f"`{term}`").alias("term"), F.lower(F.col(f"`{term}`")).alias("low")).filter(
        "low <> ''").distinct().withColumn("n", F.least(F.length("low"), F.lit(PIECE)))
    words = cut_lineage(words, "terms")
    lengths = [r.n for r in words.select("n").distinct().collect()]  # at most PIECE numbers
    if not lengths:
        return texts.select(*key, F.lit("").alias("term")).limit(0)
    low = texts.select(*key, F.lower(F.col(f"`{text}`")).alias("low")).filter("low IS NOT NULL")
    by_length = lambda c: F.concat(*[_pieces(c, n) for n in sorted(lengths)])
    of_term = words.select("term", "low", F.explode(F.array_distinct(F.coalesce(*[
        F.when(F.col("n") == n, _pieces(F.col("low"), n)) for n in lengths]))).alias("piece"))
    wanted = of_term.select("piece").distinct()
    of_text = cut_lineage(low.select(*key, F.explode(by_length(F.col("low"))).alias("piece")).join(
        wanted, "piece", "left_semi"), "pieces")
    counts = cut_lineage(of_text.groupBy("piece").agg(F.count("*").alias("texts")), "counts")
    filed = of_term.join(counts, "piece", "left").withColumn("texts", F.coalesce("texts", F.lit(0))).groupBy(
        "term", "low").agg(F.min(F.struct("texts", "piece")).alias("rarest"))
    filed = cut_lineage(filed.filter("rarest.texts > 0").select("term", "low", F.col("rarest.piece").alias("piece")), "filed")
    met = of_text.join(filed.withColumnRenamed("low", "sought"), "piece").select(*key, "term", "sought")
    return met.join(low, key).filter(F.contains("low", "sought")).select(*key, "term")


def _names(positions: Column, terms: list[str]) -> Column:
    known = F.array(*map(F.lit, terms))
    return F.transform(positions, lambda p: F.get(known, p))


def description_signal(
    df: DataFrame, column: str, terms: list[str], engine: str = "automaton"
) -> DataFrame:
    """Add description_signal, description_terms and description_reason.

    `terms` is the whole dictionary (`sources.landing.read_terms`): which projects
    qualify depends on it, so there is no built-in one.

    The reason names the first ten matching terms in dictionary order; the list
    column holds all of them.
    """
    terms = sorted(set(terms))
    found = (
        df.withColumn("_text", fold(column))
        .withColumn("_found", term_positions(F.col("_text"), terms, engine))
        .withColumn("description_terms", F.coalesce(
            _names(F.col("_found"), terms), F.array().cast("array<string>")))
    )
    hit = F.size("description_terms") > 0
    reason = (
        F.when(F.coalesce(F.col("_text"), F.lit("")) == "", F.lit("Description missing"))
        .when(hit, F.concat(F.lit("Description matched: "), F.array_join(
            F.slice("description_terms", 1, REASON_TERMS), ", ")))
        .otherwise(F.lit("No qualitative keywords found in description"))
    )
    return (found.withColumn("description_signal", hit).withColumn("description_reason", reason)
            .drop("_text", "_found"))


def word_signal(df: DataFrame, column: str, terms: list[str]) -> DataFrame:
    """Like the description terms, but only where a term stands as whole words."""
    found = description_signal(df, column, terms)
    whole = lambda t: F.concat(F.lit(" "), F.col("_words"), F.lit(" ")).contains(
        F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(t), r"(?U)[^\w]+", " ")), F.lit(" ")))
    return (
        found.withColumn("_words", F.trim(F.regexp_replace(F.lower(column), r"(?U)[^\w]+", " ")))
        .withColumn("description_terms", F.filter("description_terms", whole))
        .withColumn("description_signal", F.size("description_terms") > 0)
        .drop("_words", "description_reason")
    )


def term_frequency(df: DataFrame, column: str, terms: list[str]) -> DataFrame:
    """In how many texts does each term occur?"""
    hits = description_signal(df.select(column), column, terms)
    return (hits.select(F.explode("description_terms").alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


MASK_WORDS = 62


def _masks(words: list[str]) -> list[list[str]]:
    """The words in groups that fit the bits of one number."""
    return [words[i:i + MASK_WORDS] for i in range(0, len(words), MASK_WORDS)]


def _bits(tests: list[Column]) -> Column:
    """One bit for each test that holds."""
    mask = F.lit(0).cast("bigint")
    for i, test in enumerate(tests):
        mask = mask.bitwiseOR(F.when(test, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return mask


def _bit_of(value: Column, words: list[str]) -> Column:
    """The bit of the one word a value equals."""
    table = F.create_map(*[x for i, w in enumerate(words)
                           for x in (F.lit(w), F.lit(1 << i).cast("bigint"))])
    return F.coalesce(F.try_element_at(table, value), F.lit(0).cast("bigint"))


def _decode(mask: Column, words: list[str]) -> Column:
    """The words of a mask."""
    return F.array_compact(F.array(*[
        F.when(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(w))
        for i, w in enumerate(words)]))


def file_signals(
    files: DataFrame, keys: list[str], name: str = "file_name",
    extensions: list[str] | None = None, words: list[str] | None = None,
) -> DataFrame:
    """Per key: do file extensions or file names give qualitative evidence, and which?

    Evidence travels as bit masks merged with `bit_or`, so the state of a project
    is a few numbers however many files it has. Both word lists may have any
    length; names are short, so words are tested one by one inside the JVM.
    """
    extensions = vocab.QUALITATIVE_EXTENSIONS if extensions is None else extensions
    words = vocab.FILENAME_TERMS if words is None else words
    low, ending = F.lower(F.coalesce(F.col(name), F.lit(""))), F.col("_e")
    by_ending, by_word = _masks(list(dict.fromkeys(extensions))), _masks(list(dict.fromkeys(words)))
    marked = files.select(*keys, file_extension(name).alias("_e"), low.alias("_n"))
    merged = marked.groupBy(*keys).agg(
        *[F.bit_or(_bit_of(ending, group)).alias(f"_x{i}") for i, group in enumerate(by_ending)],
        *[F.bit_or(_bits([F.contains(F.col("_n"), F.lit(w.lower())) for w in group])).alias(f"_w{i}")
          for i, group in enumerate(by_word)],
        F.count(F.lit(1)).alias("file_count"),
    )
    seen = lambda letter, groups: F.sort_array(F.concat(
        F.array().cast("array<string>"),
        *[_decode(F.col(f"_{letter}{i}"), group) for i, group in enumerate(groups)]))
    named = (
        merged
        .withColumn("extensions", seen("x", by_ending))
        .withColumn("filename_terms", seen("w", by_word))
        .withColumn("extension_found", F.size("extensions") > 0)
        .withColumn("filename_found", F.size("filename_terms") > 0)
    )
    ext = F.array_join("extensions", ", ")
    named_words = F.array_join("filename_terms", ", ")
    e, k = F.col("extension_found"), F.col("filename_found")
    reason = (
        F.when(e & k, F.concat(F.lit("Matched extension(s): "), ext,
                               F.lit("; matched filename keyword(s): "), named_words))
        .when(e, F.concat(F.lit("Matched extension(s): "), ext))
        .when(k, F.concat(F.lit("Matched filename keyword(s): "), named_words))
        .otherwise(F.lit("No qualitative file signal found"))
    )
    return named.withColumn("file_reason", reason).drop(
        *[f"_x{i}" for i in range(len(by_ending))], *[f"_w{i}" for i in range(len(by_word))])


def phrase_matches(text: Column, phrases: list[str]) -> Column:
    """Phrases found in a text, both sides in match form; phrases fold at plan time."""
    entries = F.array(*[F.struct(F.lit(p).alias("p"), match_form(F.lit(p)).alias("m"))
                        for p in dict.fromkeys(phrases)])
    return F.transform(F.filter(entries, lambda e: F.contains(text, e["m"])), lambda e: e["p"])


def phrase_signals(
    df: DataFrame, summary: str, abstract: str, kinds: str, modes: str,
    use_kind: bool = True, use_mode: bool = True,
) -> DataFrame:
    """Add the three page signals, the decision and its reason.

    Summary and abstract are one text; an abstract that repeats the summary is
    left out. Both are brought to match form once, and the form of the joined
    text is the join of the forms.
    """
    staged = (
        df.withColumn("_cs", F.coalesce(clean_text(summary), F.lit("")))
        .withColumn("_ca", F.coalesce(clean_text(abstract), F.lit("")))
        .withColumn("_fs", match_form("_cs")).withColumn("_fa", match_form("_ca"))
        .withColumn("_same", (F.col("_cs") != "") & (F.col("_ca") != "")
                    & (F.col("_fs") == F.col("_fa")))
        .withColumn("summary_text", F.when(F.col("_same"), F.col("_cs")).otherwise(
            F.trim(F.concat_ws(" ", "_cs", "_ca"))))
        .withColumn("_s", F.when(F.col("_same"), F.col("_fs")).otherwise(
            F.trim(F.concat_ws(" ", "_fs", "_fa"))))
        .withColumn("_k", match_form(F.array_join(clean_list(kinds), " ")))
        .withColumn("_m", match_form(F.array_join(clean_list(modes), " ")))
        .withColumn("summary_matches", phrase_matches(F.col("_s"), vocab.SUMMARY_PHRASES))
        .withColumn("kind_matches", phrase_matches(F.col("_k"), vocab.KIND_PHRASES))
        .withColumn("mode_matches", phrase_matches(F.col("_m"), vocab.COLLECTION_PHRASES))
        .withColumn("summary_signal", F.size("summary_matches") > 0)
        .withColumn("kind_signal", F.size("kind_matches") > 0)
        .withColumn("mode_signal", F.size("mode_matches") > 0)
    )
    enabled = ["summary"] + ["kind"] * use_kind + ["collection"] * use_mode
    reason = (
        F.when(F.col("summary_signal"), F.lit("summary_signal_pass"))
        .when(F.lit(use_kind) & F.col("kind_signal"), F.lit("kind_signal_pass"))
        .when(F.lit(use_mode) & F.col("mode_signal"), F.lit("collection_signal_pass"))
        .otherwise(F.lit("no_enabled_signal_matched:" + "+".join(enabled)))
    )
    return (
        staged.withColumn("decision_reason", reason)
        .withColumn("qualitative", ~F.startswith("decision_reason", F.lit("no_enabled")))
        .drop("_cs", "_ca", "_fs", "_fa", "_same", "_s", "_k", "_m")
    )


def classify_projects(projects: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Join the file signals to described projects and decide.

    `projects` carries `description_signal`; a project is qualitative when its
    description and one of its file signals say so.
    """
    found = file_signals(files, [key])
    joined = projects.join(found, key, "left")
    ext = F.coalesce("extension_found", F.lit(False))
    names = F.coalesce("filename_found", F.lit(False))
    return (
        joined.withColumn("extension_found", ext).withColumn("filename_found", names)
        .withColumn("has_files", F.col("file_count").isNotNull())
        .withColumn("qualitative", F.col("description_signal") & (ext | names))
        .withColumn("file_reason", F.coalesce(
            "file_reason", F.lit("No qualitative file signal found")))
    )
