"""The operators of this subpackage as registered queries with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart.llm import extraction, forest, host_rules, mixing, neighbours, packing, phrases, quality, ranked, records, repeats, simhash, url_filter
from stratamart.llm.tokens import Encoding
from stratamart.sources.listings import read_table

Query = Callable[[SparkSession, str], DataFrame]

#: Production parameters.
SIMHASH_SHINGLE, SIMHASH_BITS = 4, 4
LEAST_COSINE = 0.95
NEIGHBOURS, QUERY_STEP = 20, 20
RANKED, PHRASES = 20, 2000
#: The fold of documents that the classifier never learns from.
FOLDS, HELD_OUT = 3, 1


def byte_encoding() -> Encoding:
    return Encoding(public_tokenizers.path("byte_bpe_50k.json"), " ", 0, 50_257)


def word_encoding() -> Encoding:
    return Encoding(public_tokenizers.path("word_bpe_49k.json"), "", 1, 49_408, True)


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), SIMHASH_SHINGLE, SIMHASH_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(read_table(spark, sf_dir, "embeddings"), LEAST_COSINE)


def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.write(read_table(spark, sf_dir, "documents"), byte_encoding())
    return records.read(index).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read_table(spark, sf_dir, "documents"), word_encoding())
    digests = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Fitted on the labelled documents outside the held-out fold. Labels grow with the documents, so both are
    joined by their ids at every size, never by broadcast."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.fit(docs.where(~held_out()).join(labels.hint("merge"), "doc_id"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    return quality.score(docs, quality_model(spark, sf_dir)).select("doc_id", "held_out", "score", "predicted")


def dated_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list from the events: each names a pattern of the page its user stands for, the event's type is the verdict."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("user_id"), "url")
    events = read_table(spark, sf_dir, "events").where("event_type in ('purchase', 'signup', 'error')")
    host = url_filter.host_of("url")
    kind = F.element_at(F.array(*map(F.lit, url_filter.KINDS)), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    pattern = (F.when(F.col("kind") == "domain", F.regexp_replace(host, r"^[^.]*\.", "")).when(F.col("kind") == "host", host)
               .otherwise(F.concat(host, F.regexp_extract(url_filter.path_of("url"), "^/[^/]*/?", 0))))
    verdict = F.when(F.col("event_type") == "purchase", "block").when(F.col("event_type") == "signup", "allow").otherwise("clear")
    return events.join(pages, "user_id").withColumn("kind", kind).select("kind", pattern.alias("pattern"), verdict.alias("verdict"), F.col("ts").alias("since"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched at the time of the event of its number, against the list in force then."""
    fetched = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("page_id"), F.col("ts").alias("fetched_at"))
    captures = read_table(spark, sf_dir, "pages").select("page_id", "url").join(fetched, "page_id", "left")
    return url_filter.filter_urls(captures, dated_lists(spark, sf_dir))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return forest.search(rows.where(F.col("vec_id") % QUERY_STEP == 0), rows, NEIGHBOURS)


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words("text").alias("words"), F.xxhash64("text").alias("content"))
    return mixing.mix(docs, F.col("words"), identity=("doc_id", "content")).select("doc_id", "size", "source_size", "target", "taken")


def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.removed_spans(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def host_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source."""
    judged = host_rules.judge(read_table(spark, sf_dir, "documents"), F.col("source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), RANKED)


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.best(phrases.mine(read_table(spark, sf_dir, "documents")), PHRASES)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run  # it imports this module

    return run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": extract_pages,
        "op2_simhash_near_dedup": simhash_near_duplicates,
        "op3_embedding_near_dedup": embedding_near_duplicates,
        "op4_token_records": token_records,
        "op5_best_fit_packing": best_fit_packing,
        "op6_quality_classifier": quality_scores,
        "op7_url_filters": url_filters,
        "op8_nearest_neighbours": nearest_neighbours,
        "op9_mix_sources": mixed_sources,
        "op10_suffix_array_dedup": without_repeats,
        "op11_host_rules": host_verdicts,
        "op12_ranked_search": ranked_search,
        "op13_phrase_collocations": phrase_collocations,
        "pipeline": pipeline,
    }


_URL_FILTERS = r"""
WITH url_parts AS (
  SELECT page_id, url,
    coalesce(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)', 1)), '') AS host,
    trim(coalesce(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)', 2), ''), '/') AS path
  FROM pages),
entries AS (
  SELECT CASE e.event_id % 3 WHEN 0 THEN 'domain:' || regexp_replace(p.host, '^[^.]*\.', '') WHEN 1 THEN 'host:' || p.host
           ELSE 'prefix:' || p.host || '/' || CASE WHEN p.path = '' THEN '' ELSE split_part(p.path, '/', 1) || '/' END END AS k,
    max(CASE e.event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 ELSE 1 END) AS verdict, e.ts AS since
  FROM events e JOIN url_parts p ON p.page_id = e.user_id
  WHERE e.event_type IN ('purchase', 'signup', 'error') GROUP BY 1, 3),
validity AS (SELECT *, lead(since) OVER (PARTITION BY k ORDER BY since) AS until FROM entries),
captures AS (SELECT row_number() OVER () AS n, p.*, e.ts AS fetched_at FROM url_parts p LEFT JOIN events e ON e.event_id = p.page_id),
asked AS (
  SELECT n, fetched_at, unnest(list_concat(['host:' || host],
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: 'domain:' || array_to_string(string_split(host, '.')[i:], '.')),
    list_transform(range(0, CASE WHEN path = '' THEN 0 ELSE len(string_split(path, '/')) END + 1),
      lambda i: 'prefix:' || host || '/' || CASE WHEN i = 0 THEN '' ELSE array_to_string(string_split(path, '/')[1:i], '/') || '/' END))) AS k
  FROM captures WHERE host <> ''),
matched AS (
  SELECT a.n, v.*, row_number() OVER (PARTITION BY a.n ORDER BY CASE split_part(v.k, ':', 1) WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC,
    length(v.k) DESC) AS place
  FROM asked a JOIN validity v ON v.k = a.k AND v.since <= a.fetched_at AND (v.until IS NULL OR a.fetched_at < v.until)
  WHERE v.verdict > 1)
SELECT c.page_id, c.url, c.fetched_at, m.k AS matched, CASE m.verdict WHEN 3 THEN 'block' WHEN 2 THEN 'allow' END AS verdict,
  m.since AS valid_from, m.until AS valid_until, coalesce(m.verdict <> 3, TRUE) AS kept
FROM captures c LEFT JOIN matched m ON m.n = c.n AND m.place = 1
"""


_HOST_RULES = r"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
lines AS (
  SELECT d, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT d, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY d),
placed AS (SELECT d, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (SELECT a.d, a.i, count(*) OVER (PARTITION BY a.d, a.word, b.word, c.word) AS seen
  FROM placed a JOIN placed b ON b.d = a.d AND b.i = a.i + 1 JOIN placed c ON c.d = a.d AND c.i = a.i + 2),
repeated AS (SELECT d, count(DISTINCT i + step) AS n_repeat_words FROM windows, (SELECT unnest([0, 1, 2]) AS step) WHERE seen > 1 GROUP BY d),
measured AS (
  SELECT s.d, doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN lines USING (d) LEFT JOIN repeated USING (d)),
tested AS (SELECT *, [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words,
  word_chars < 3 * n_words OR word_chars > 10 * n_words, 100 * n_dup_lines > 30 * n_lines] AS fails FROM measured),
hosts AS (SELECT source, rule, count(*) AS n, count(*) FILTER (fails[rule]) AS k FROM tested, (SELECT unnest([1, 2, 3, 4, 5]) AS rule) GROUP BY ALL),
sums AS (SELECT rule, count(*) - 1.0 AS free, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(n * n)::DOUBLE AS nn, sum(k::DOUBLE * k / n) AS kk FROM hosts GROUP BY rule),
priors AS (SELECT rule, k / n AS mean, least(coalesce(CASE WHEN n - nn / n - free > 0 AND k > 0 AND k < n
  THEN ((kk - k * k / n) / (k / n * (1 - k / n)) - free) / (n - nn / n - free) END, 0), 1 - 1e-9) AS alike FROM sums),
verdicts AS (SELECT source, max(CASE WHEN alike <= 0 THEN mean ELSE (k + mean * (1 / alike - 1)) / (n + 1 / alike - 1) END) > 0.5 AS failed
  FROM hosts JOIN priors USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fails[1] OR fails[2] AS base_failed, NOT (fails[1] OR fails[2] OR failed) AS kept
FROM tested t JOIN verdicts v ON v.source IS NOT DISTINCT FROM t.source
"""

_RANKED_SEARCH = r"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
wanted AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
totals AS (SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM docs WHERE len(terms) > 0),
postings AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term),
impacts AS (SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(terms) * big_n) // big_l))) AS impact
  FROM postings JOIN docs USING (d) JOIN weights USING (term), totals),
scored AS (SELECT q, item_id, d, doc_id, sum(times * impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
counted AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
        FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
listed AS (SELECT *, string_split(phrase, ' ') AS words FROM counted WHERE k > 1),
cuts AS (
  SELECT c.*, cut, l.f AS l, r.f AS r, n, ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM listed c JOIN (SELECT unnest([1, 2, 3, 4]) AS cut) ON cut < k JOIN totals USING (lang)
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(words[:cut], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts) WHERE place = 1),
inside AS (
  SELECT DISTINCT lang, part FROM (SELECT lang, f, unnest(list_transform(range(1, k - j + 2), lambda i: array_to_string(words[i:i + j - 1], ' '))) AS part
    FROM listed, (SELECT unnest([2, 3, 4]) AS j) WHERE j < k) o JOIN counted s USING (lang) WHERE s.phrase = part AND 100 * o.f >= 100 * s.f)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS rank, phrase, f AS a, l, r, n, score
      FROM lowest c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.part = c.phrase)) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_url_filters": _URL_FILTERS, "op11_host_rules": _HOST_RULES, "op12_ranked_search": _RANKED_SEARCH, "op13_phrase_collocations": _PHRASES}
