"""Text, signature, near-duplicate, comparison and markup queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import markup, minhash, text
from folioscope.operators import classify, compare, extract, names, report
from folioscope.plans.catalogue import query
from folioscope.plans.frames import table
from folioscope.sources import readers

#: Distinct character trigrams in SQL; shorter texts are their own only one.
GRAMS_SQL = "CASE WHEN length({v}) >= 3 THEN list_distinct(list_transform(range(1, length({v}) - 1), lambda i: substring({v}, i, 3))) WHEN length({v}) > 0 THEN [{v}] ELSE [] END"
#: Hashes of a signature, the operator's default.
COUNT = 100


@query("q16_ngrams", f"SELECT p_partkey, array_to_string(list_sort({GRAMS_SQL.format(v='p_name')}), '|') AS grams FROM part")
def _q16(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(text.ngrams(F.col("p_name"), 3)), "|").alias("grams"))


def _signature_sql(column: str) -> str:
    cells = ", ".join(f"list_min(list_transform(xs, lambda x: (x * {a} + {b}) % {minhash.PRIME}))" for a, b in minhash.coefficients(COUNT))
    numbers = f"list_transform({GRAMS_SQL.format(v=column)}, lambda g: CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) % {minhash.PRIME})"
    return f"sig AS (SELECT p_partkey, [{cells}] AS s FROM (SELECT p_partkey, {numbers} AS xs FROM part))"


def _signatures(spark, sf, column: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", minhash.signature(text.ngrams(F.col(column), 3), COUNT).alias("s"))


@query("q17_minhash_signature", f"WITH {_signature_sql('p_type')} SELECT p_partkey, array_to_string(s, ',') AS signature FROM sig")
def _q17(spark, sf):
    return _joined(_signatures(spark, sf, "p_type"))


@query("q17b_minhash_signature_full", f"WITH {_signature_sql('p_name')} SELECT p_partkey, array_to_string(s, ',') AS signature FROM sig")
def _q17b(spark, sf):
    return _joined(_signatures(spark, sf, "p_name"))


def _joined(signed: DataFrame) -> DataFrame:
    return signed.select("p_partkey", F.array_join(F.col("s").cast("array<string>"), ",").alias("signature"))


@query("q18_signature_similarity", f"WITH {_signature_sql('p_type')} SELECT a.p_partkey, len(list_filter(list_zip(a.s, b.s), lambda z: z[1] = z[2])) / {COUNT} AS similarity FROM sig a JOIN sig b ON b.p_partkey = a.p_partkey + 1")
def _q18(spark, sf):
    return _to_next(spark, sf, "p_type")


@query("q18b_signature_similarity_full", f"WITH {_signature_sql('p_name')} SELECT a.p_partkey, len(list_filter(list_zip(a.s, b.s), lambda z: z[1] = z[2])) / {COUNT} AS similarity FROM sig a JOIN sig b ON b.p_partkey = a.p_partkey + 1")
def _q18b(spark, sf):
    return _to_next(spark, sf, "p_name")


def _to_next(spark, sf, column: str) -> DataFrame:
    """Neighbours meet by their values and are signed together, so signatures are neither shuffled nor broadcast."""
    here = table(spark, sf, "part").select("p_partkey", F.col(column).alias("here"))
    after = here.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("here").alias("after"))
    s, t = (minhash.signature(text.ngrams(F.col(c), 3), COUNT) for c in ("here", "after"))
    return here.join(after.hint("merge"), "p_partkey").select("p_partkey", minhash.similarity(s, t).alias("similarity"))


#: Names by category in two spellings, with near and exact repeats.
VALUES_SQL = "v AS (SELECT DISTINCT p_brand AS category, CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) WHEN p_partkey % 5 = 1 THEN p_name || ' x' ELSE p_name END AS value FROM part)"
PAIRS_SQL = (
    f"g AS (SELECT category, value, {GRAMS_SQL.format(v='value')} AS grams FROM v), "
    "p AS (SELECT a.category, a.value AS v1, b.value AS v2, CAST(len(list_intersect(a.grams, b.grams)) AS DOUBLE) / len(list_distinct(list_concat(a.grams, b.grams))) AS similarity "
    "FROM g a JOIN g b ON a.category = b.category AND a.value < b.value), pairs AS (SELECT * FROM p WHERE similarity > 0.5)"
)
KEPT_SQL = (
    "c AS (SELECT replace(lower(value), ' ', '') AS norm, value, count(*) AS n FROM v GROUP BY 1, 2), "
    "best AS (SELECT norm, value AS b FROM c QUALIFY row_number() OVER (PARTITION BY norm ORDER BY n DESC, value) = 1), "
    "gone AS (SELECT DISTINCT category, CASE WHEN v1 = x.b AND v2 <> y.b THEN v2 WHEN v2 = y.b AND v1 <> x.b THEN v1 ELSE greatest(v1, v2) END AS value "
    "FROM pairs JOIN best x ON x.norm = replace(lower(v1), ' ', '') JOIN best y ON y.norm = replace(lower(v2), ' ', '')), "
    "kept AS (SELECT * FROM v ANTI JOIN gone USING (category, value))"
)


def _values(spark, sf) -> DataFrame:
    k = F.col("p_partkey") % 5
    value = F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat("p_name", F.lit(" x"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select(F.col("p_brand").alias("category"), value.alias("value")).distinct()


@query("q19_exact_jaccard_pairs", f"WITH {VALUES_SQL}, {PAIRS_SQL} SELECT category, v1, v2, round(similarity, 9) AS similarity FROM pairs")
def _q19(spark, sf):
    return names.similar_pairs(_values(spark, sf)).withColumn("similarity", F.round("similarity", 9))


@query("q20_near_dup_removed", f"WITH {VALUES_SQL}, {PAIRS_SQL}, {KEPT_SQL} SELECT category, value FROM kept")
def _q20(spark, sf):
    return names.remove_near_duplicates(_values(spark, sf))


@query("q21_standardised", f"WITH {VALUES_SQL}, {PAIRS_SQL}, {KEPT_SQL}, k AS (SELECT replace(lower(value), ' ', '') AS norm, value, count(*) AS kept FROM kept GROUP BY 1, 2), s AS (SELECT c.norm, c.value AS b FROM c LEFT JOIN k USING (norm, value) QUALIFY row_number() OVER (PARTITION BY c.norm ORDER BY n DESC, coalesce(kept, 0) DESC, c.value) = 1) SELECT DISTINCT category, b AS value FROM kept JOIN s ON norm = replace(lower(value), ' ', '')")
def _q21(spark, sf):
    values = _values(spark, sf)
    return names.standardise(values, names.remove_near_duplicates(values))


@query("q21b_renamed_stats", f"WITH {VALUES_SQL}, c AS (SELECT replace(lower(value), ' ', '') AS norm, min(value) AS b FROM v GROUP BY 1), r AS (SELECT p_brand AS category, p_name AS author, p_partkey AS ordinal FROM part) SELECT category, author, ordinal, coalesce(b, author) AS key FROM r LEFT JOIN c ON norm = replace(lower(author), ' ', '') QUALIFY row_number() OVER (PARTITION BY category, coalesce(b, author) ORDER BY ordinal DESC, author) = 1")
def _q21b(spark, sf):
    stats = table(spark, sf, "part").select(F.col("p_brand").alias("category"), F.col("p_name").alias("author"), F.col("p_partkey").alias("ordinal"))
    return names.rename(stats, _values(spark, sf))


@query("q21c_minhash_pairs")
def _q21c(spark, sf):
    return names.minhash_pairs(_values(spark, sf))


#: Whole texts, regularised. Sides are by language here, by source further down.
REGULAR_SQL = r"regexp_replace(lower(text), '[^\p{L}\p{N}_]+', '', 'g')"
ENGLISH, OTHERS = "lang = 'en'", "(lang <> 'en' OR lang IS NULL)"


def _titles(spark, sf, condition: str) -> DataFrame:
    return table(spark, sf, "documents").where(condition).select(F.col("text").alias("title"))


@query("q23_regularise", f"SELECT doc_id, {REGULAR_SQL} AS title FROM documents")
def _q23(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.regularise(F.col("text")).alias("title"))


SIDES_SQL = f"l AS (SELECT DISTINCT {REGULAR_SQL} AS title FROM documents WHERE {ENGLISH}), r AS (SELECT DISTINCT {REGULAR_SQL} AS title FROM documents WHERE {OTHERS}), s AS (SELECT coalesce(l.title, r.title) AS title, CASE WHEN l.title IS NOT NULL AND r.title IS NOT NULL THEN 'both' WHEN r.title IS NULL THEN 'left' ELSE 'right' END AS side FROM l FULL JOIN r ON l.title = r.title WHERE coalesce(l.title, r.title) <> '')"


def _sides(spark, sf) -> DataFrame:
    return compare.compare(compare.regularised(_titles(spark, sf, ENGLISH)), compare.regularised(_titles(spark, sf, OTHERS)))


@query("q24_set_compare", f"WITH {SIDES_SQL} SELECT title, side FROM s")
def _q24(spark, sf):
    return _sides(spark, sf)


@query("q25_similar_titles", "WITH n AS (SELECT DISTINCT replace(lower(p_type), ' ', '') AS title FROM part), m AS (SELECT DISTINCT replace(lower(p_name), ' ', '') AS title FROM part), a AS (SELECT title, list_distinct(string_split(title, '')) AS c FROM n), b AS (SELECT title, list_distinct(string_split(title, '')) AS c FROM m) SELECT DISTINCT a.title FROM a JOIN b ON len(list_intersect(a.c, b.c)) >= 0.8 * len(list_distinct(list_concat(a.c, b.c)))")
def _q25(spark, sf):
    part = table(spark, sf, "part")
    types, called = (compare.regularised(part.select(F.col(c).alias("title"))) for c in ("p_type", "p_name"))
    return compare.fuzzy_semi_join(types, called)


@query("q25b_similar_names", "WITH n AS (SELECT DISTINCT replace(lower(p_name), ' ', '') AS title FROM part WHERE p_size < 25), m AS (SELECT DISTINCT replace(lower(p_name), ' ', '') AS title FROM part WHERE p_size >= 25), a AS (SELECT title, list_distinct(string_split(title, '')) AS c FROM n), b AS (SELECT title, list_distinct(string_split(title, '')) AS c FROM m) SELECT DISTINCT a.title FROM a JOIN b ON len(list_intersect(a.c, b.c)) >= 0.8 * len(list_distinct(list_concat(a.c, b.c)))")
def _q25b(spark, sf):
    """Names of small parts that look like one of a large part."""
    part = table(spark, sf, "part").withColumn("title", F.col("p_name"))
    return compare.fuzzy_semi_join(compare.regularised(part.where("p_size < 25")), compare.regularised(part.where("p_size >= 25")))


@query("q26_recall_pct", f"WITH {SIDES_SQL}, c AS (SELECT count_if(side = 'both') AS found, count_if(side = 'left') AS l, count_if(side = 'right') AS r FROM s) SELECT CAST(found AS BIGINT) AS found, CAST(l AS BIGINT) AS left_only, CAST(r AS BIGINT) AS right_only, round(100.0 * r / (found + r), 2) AS missing_percent, round(100 - 100.0 * r / (found + r), 2) AS recall_percent, CAST(floor((found + r) / r) AS BIGINT) AS one_in FROM c")
def _q26(spark, sf):
    return compare.summary(_sides(spark, sf))


#: Sides by source; documents without one are on the right.
WHOLE_SQL = REGULAR_SQL
LEFT, RIGHT = "source < 'src2'", "(source >= 'src2' OR source IS NULL)"


@query("q23b_regularise_whole", f"SELECT doc_id, {WHOLE_SQL} AS title FROM documents")
def _q23b(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.regularise(F.col("text")).alias("title"))


WHOLE_SIDES_SQL = f"l AS (SELECT DISTINCT {WHOLE_SQL} AS title FROM documents WHERE {LEFT}), r AS (SELECT DISTINCT {WHOLE_SQL} AS title FROM documents WHERE {RIGHT}), s AS (SELECT coalesce(l.title, r.title) AS title, CASE WHEN l.title IS NOT NULL AND r.title IS NOT NULL THEN 'both' WHEN r.title IS NULL THEN 'left' ELSE 'right' END AS side FROM l FULL JOIN r ON l.title = r.title WHERE coalesce(l.title, r.title) <> '')"


def _whole_sides(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    return compare.compare(*(compare.regularised(docs.where(side), "text") for side in (LEFT, RIGHT)))


@query("q24b_compare_sources", f"WITH {WHOLE_SIDES_SQL} SELECT title, side FROM s")
def _q24b(spark, sf):
    return _whole_sides(spark, sf)


@query("q26b_recall_sources", f"WITH {WHOLE_SIDES_SQL}, c AS (SELECT count_if(side = 'both') AS found, count_if(side = 'left') AS l, count_if(side = 'right') AS r FROM s) SELECT CAST(found AS BIGINT) AS found, CAST(l AS BIGINT) AS left_only, CAST(r AS BIGINT) AS right_only, round(100.0 * r / (found + r), 2) AS missing_percent, round(100 - 100.0 * r / (found + r), 2) AS recall_percent, CAST(floor((found + r) / r) AS BIGINT) AS one_in FROM c")
def _q26b(spark, sf):
    return compare.summary(_whole_sides(spark, sf))


@query("q27_citation_title", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 2 THEN array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') ELSE p_name END AS title FROM part")
def _q27(spark, sf):
    """One shape of citation for each remainder: journal, address, capitals, plain, in press."""
    shapes = [("(2019). ", "p_name", ". Journal Of Parts 3(2) [note]"), ("(2019). ", "p_name", ". https://x.org/a"), ("(2019). ", F.upper("p_name"), ". 12 pages"), ("(2019). ", "p_name", ". 12 pages"), ("(in press). ", "p_name", ". Parts")]
    citation = F.element_at(F.array(*[F.concat(F.lit("Doe, J. " + before), name, F.lit(after)) for before, name, after in shapes]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", text.citation_title(citation).alias("title"))


@query("q42_meta_candidates")
def _q42(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.array_join(markup.abstract_candidates(F.col("html")), "\n").alias("candidates"))


@query("q43_strip_tags", "SELECT page_id, trim(regexp_replace(html, '<[^>]+>', '', 'g'), ' ') AS plain FROM pages")
def _q43(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


@query("q44_jats_markdown")
def _q44(spark, sf):
    return table(spark, sf, "pages").select("page_id", markup.to_markdown(F.col("html")).alias("markdown"))


WORDS_SQL = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"


@query("q45_word_counts", f"SELECT doc_id, CAST({WORDS_SQL} AS BIGINT) AS words, CAST({WORDS_SQL} * 0.75 AS DOUBLE) AS tokens, length(text) AS chars FROM documents")
def _q45(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.word_counts(F.col("text")).alias("c")).select("doc_id", "c.*")


@query("q46_json_props", "SELECT event_id, CAST(len(json_keys(props)) AS BIGINT) AS n_keys, array_to_string(list_sort(json_keys(props)), '|') AS keys FROM events")
def _q46(spark, sf):
    keys = F.map_keys(F.from_json("props", "map<string, string>"))
    return table(spark, sf, "events").select("event_id", F.size(keys).cast("long").alias("n_keys"), F.array_join(F.array_sort(keys), "|").alias("keys"))


class Forgetful(classify.KeywordClient):
    """Answers with a label that doesn't exist until it is told so; for texts that begin with a vowel it never learns."""

    def choose(self, text, level, parent, options, banned):
        if not banned or text[:1].lower() in "aeiou":
            return [f"no such {level}"]
        return super().choose(text, level, parent, options, banned)


@query("q51_validate_retry")
def _q51(spark, sf):
    """Every choice is refused once and asked for again; documents that never get a valid one come back with their error."""
    tree = {"Common words": {"English": ["the and of", "is are was"], "French": ["le la les", "de du des"]}, "Other words": {"German": ["der die das"], "Spanish": ["el los las"]}}
    done = classify.classify(table(spark, sf, "documents").select("doc_id", "text"), "text", tree, Forgetful)
    lists = {c: F.array_join(f"classification.{c}", "|") for c in ("top", "mid", "low", "themes")}
    return done.select("doc_id", "classification.error", *[e.alias(c) for c, e in lists.items()])


@query("q53_section_fill", "WITH l AS (SELECT conv_id AS doc, turn AS line, CASE WHEN turn % 3 = 0 THEN 'part ' || turn ELSE NULL END AS own, role || ' ' || turn AS citation FROM conversations) SELECT doc, line, section, citation, CAST(line AS VARCHAR) AS total FROM (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line) AS section FROM l) WHERE own IS NULL")
def _q53(spark, sf):
    line = F.col("turn").cast("string")
    cells = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("| part "), line, F.lit(" |"))).otherwise(F.concat(F.lit("|"), F.col("role"), F.lit(" "), line, F.lit(" | "), line, F.lit("|")))
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("line"), cells.alias("value"))
    return readers.citation_table(rows, skip=0)


@query("q58_clean_text", r"SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[!-/:-@\[-`{-~]', '', 'g'), '\s+', ' ', 'g')) AS cleaned FROM part")
def _q58(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.clean(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))).alias("cleaned"))


@query("q59_edit_ratio", "SELECT p_partkey, round(100 * (1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type))), 2) AS ratio FROM part")
def _q59(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.edit_ratio(F.col("p_name"), F.col("p_type")).alias("ratio"))


@query("q60_case_forms", "SELECT p_partkey, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS sentence, substr(p_name, 1, 5) || '...' AS short FROM part")
def _q60(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.sentence_case(F.col("p_type")).alias("sentence"), text.shorten(F.col("p_name"), 5).alias("short"))


@query("q61_tagged_record", "SELECT doc_id, 'PT J' || chr(10) || 'AU ' || source || chr(10) || 'TI ' || lang || chr(10) || 'AB No abstract' || chr(10) || 'ER' AS record FROM documents")
def _q61(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.tagged_record(F.array("source"), F.col("lang"), F.lit(None).cast("string")).alias("record"))


@query("q62_ascii_fold")
def _q62(spark, sf):
    return table(spark, sf, "documents").select("doc_id", markup.ascii_fold(F.col("text")).alias("folded"))


@query("q63_match_ratio")
def _q63(spark, sf):
    return table(spark, sf, "part").select("p_partkey", markup.match_ratio(F.col("p_name"), F.col("p_type")).alias("ratio"))


BEST_SQL = "round(100 * (1 - levenshtein(t.v, m.v) / greatest(length(t.v), length(m.v))), 2)"


@query("q64_best_match", f"WITH t AS (SELECT DISTINCT p_brand AS b, p_type AS v FROM part), m AS (SELECT DISTINCT p_brand AS b, p_name AS v FROM part) SELECT t.b AS block, t.v AS value, m.v AS best, {BEST_SQL} AS ratio FROM t JOIN m USING (b) QUALIFY row_number() OVER (PARTITION BY t.b, t.v ORDER BY {BEST_SQL} DESC, m.v) = 1")
def _q64(spark, sf):
    part = table(spark, sf, "part")
    left, right = (part.select(F.col("p_brand").alias("block"), F.col(c).alias("value")) for c in ("p_type", "p_name"))
    return compare.best_match(left, right, "block", "value")


@query("q64b_misspelt_match", f"WITH t AS (SELECT DISTINCT p_brand AS b, CASE WHEN p_partkey % 3 = 0 THEN substr(p_name, 2) WHEN p_partkey % 3 = 1 THEN p_name || 's' ELSE replace(p_name, 'e', 'i') END AS v FROM part), m AS (SELECT DISTINCT p_brand AS b, p_name AS v FROM part) SELECT t.b AS block, t.v AS value, m.v AS best, {BEST_SQL} AS ratio FROM t JOIN m USING (b) QUALIFY row_number() OVER (PARTITION BY t.b, t.v ORDER BY {BEST_SQL} DESC, m.v) = 1")
def _q64b(spark, sf):
    """Names in three misspellings, matched with the names of their brand."""
    part, k = table(spark, sf, "part").withColumnRenamed("p_brand", "block"), F.col("p_partkey") % 3
    wrong = F.when(k == 0, F.expr("substr(p_name, 2)")).when(k == 1, F.concat("p_name", F.lit("s"))).otherwise(F.replace("p_name", F.lit("e"), F.lit("i")))
    return compare.best_match(part.select("block", wrong.alias("value")), part.select("block", F.col("p_name").alias("value")), "block", "value")


@query("q65_longest_name", "SELECT p_brand AS brand, p_name AS longest FROM (SELECT DISTINCT p_brand, p_name FROM part) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY NOT regexp_matches(p_name, '^[a-m]'), length(p_name) DESC, p_name) = 1")
def _q65(spark, sf):
    return compare.longest(table(spark, sf, "part").withColumnRenamed("p_brand", "brand"), "brand", "p_name", "^[a-m]")


@query("q66_shape_filter", "SELECT p_partkey FROM part WHERE regexp_matches(p_name, '^[a-z]+ [a-z]*ing?[a-z]*$') AND p_type <> 'ECONOMY'")
def _q66(spark, sf):
    return table(spark, sf, "part").where(F.col("p_name").rlike("^[a-z]+ [a-z]*ing?[a-z]*$") & (F.col("p_type") != "ECONOMY")).select("p_partkey")


@query("q67_contains_not_equal", "SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE contains(n_name, 'NATION_1') AND n_name <> 'NATION_1'")
def _q67(spark, sf):
    both = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return both.where(F.contains("n_name", F.lit("NATION_1")) & (F.col("n_name") != "NATION_1")).select("s_suppkey")


@query("q68_large_groups_first", "SELECT p_brand AS brand, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 3 ORDER BY n DESC, brand LIMIT 20")
def _q68(spark, sf):
    sizes = table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"))
    return report.first_sorted(sizes.where("n > 3"), 20, F.desc("n"), F.col("brand"))


@query("q69_same_text", r"WITH d AS (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')) AS c FROM documents), f AS (SELECT c, min(doc_id) AS found FROM d GROUP BY 1) SELECT doc_id, found FROM d LEFT JOIN f USING (c)")
def _q69(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return compare.same_text(docs, docs, "text", "doc_id").select("doc_id", "found")


@query("q70_lookup_with_default", "SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'none') AS quality FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)")
def _q70(spark, sf):
    known = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return table(spark, sf, "documents").select("doc_id").join(known, "doc_id", "left").select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("none")).alias("quality"))


@query("q71_first_part_clamped", "SELECT page_id, trim(split_part(url, '/', 3)) AS host, greatest(length(url) * 10, 200) AS size FROM pages")
def _q71(spark, sf):
    host = F.trim(F.split_part("url", F.lit("/"), F.lit(3)))
    return table(spark, sf, "pages").select("page_id", text.first_part(F.concat(host, F.lit(",x"))).alias("host"), text.clamped(F.length("url"), 200, 10).cast("long").alias("size"))


@query("q72_extracted_list", "SELECT lang, count(*) AS n, count(DISTINCT text) AS distinct_texts FROM documents WHERE text IS NOT NULL GROUP BY 1")
def _q72(spark, sf):
    texts = table(spark, sf, "documents").where("text IS NOT NULL")
    return texts.groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("distinct_texts"))


@query("q72b_extracted_items", "SELECT doc_id, 'titles' AS list, source AS item FROM documents WHERE source IS NOT NULL UNION ALL SELECT doc_id, 'abstracts', text FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, 'languages', lang FROM documents WHERE lang IS NOT NULL")
def _q72b(spark, sf):
    """The lists themselves."""
    return extract.extracted_lists(table(spark, sf, "documents"), "doc_id", {"titles": "source", "abstracts": "text", "languages": "lang"})


@query("q73_match_counters", "SELECT p_brand AS brand, count(*) FILTER (p_partkey % 3 = 0) AS matched, count(*) FILTER (p_partkey % 3 <> 0) AS unmatched FROM part GROUP BY 1")
def _q73(spark, sf):
    """Citations with and without a recognisable title."""
    citation = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Doe, J. (2019). "), "p_name", F.lit(". Parts"))).otherwise(F.concat("p_name", F.lit(", no year")))
    found = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), text.citation_title(citation).alias("title"))
    return found.groupBy("brand").agg(F.count_if(F.col("title").isNotNull()).alias("matched"), F.count_if(F.col("title").isNull()).alias("unmatched"))


@query("q74_warning_counts", "SELECT warning, count(*) AS n FROM (SELECT 'no text' AS warning FROM documents WHERE text IS NULL OR text = '' UNION ALL SELECT 'no source' FROM documents WHERE source IS NULL UNION ALL SELECT 'no language' FROM documents WHERE lang IS NULL) GROUP BY 1")
def _q74(spark, sf):
    kinds = {"no text": F.coalesce(F.col("text") == "", F.lit(True)), "no source": F.col("source").isNull(), "no language": F.col("lang").isNull()}
    found = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()]), lambda x: x.isNotNull())
    return table(spark, sf, "documents").select(F.explode(found).alias("warning")).groupBy("warning").agg(F.count("*").alias("n"))


@query("q75_page_records")
def _q75(spark, sf):
    found = table(spark, sf, "pages").select("page_id", markup.page_records(F.col("html")).alias("r"))
    return found.select("page_id", "r.page_content", F.to_json("r.extra_context").alias("extra_context"))


@query("q78_latex_text", "SELECT p_partkey, p_name || ' — “' || p_type || '” (α ≤ ' || p_size || '/2) é' AS plain FROM part")
def _q78(spark, sf):
    source = F.concat(F.lit("\\emph{"), "p_name", F.lit("} --- ``\\textbf{{"), "p_type", F.lit("}}''~($\\alpha \\leq \\frac{"), F.col("p_size").cast("string"), F.lit("}{2}$) \\'e % a note"))
    return table(spark, sf, "part").select("p_partkey", markup.latex_text(source).alias("plain"))
