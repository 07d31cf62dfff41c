"""The operators of this subpackage as queries over the test tables, and their SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    chat_format,
    embedding_dedup,
    html_text,
    mixing,
    packing,
    periodic_runs,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    url_filters,
    warc,
    whitening,
)
from newsloom.llm.common import store, table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    text = html_text.extract_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labels."""
    return quality_classifier.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page."""
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it in every document."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    n_base = len(pii.KINDS) - 1

    def joined(spans: str) -> Column:
        kinds = ", ".join(f"'{kind}'" for kind in pii.KINDS)
        named = f"transform({spans}, x -> concat_ws(':', array({kinds})[x.kind], x.start, x.end))"
        return F.array_join(F.expr(named), ",")

    return found.select(
        "doc_id",
        *[
            F.size(F.expr(f"filter(spans, x -> x.kind = {k})")).cast("bigint").alias(f"n_{pii.KINDS[k]}")
            for k in range(n_base)
        ],
        F.sha2(joined(f"filter(spans, x -> x.kind < {n_base})"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules count in every document, and whether it is kept."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


# Every tenth document by hash, from some word on, repeats what stands there with a period.
_WITH_PERIODS = r"""
CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 10 = 0 THEN
  array_join(flatten(transform(
    array(struct(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0) AS w,
                 crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) div 10 AS g)),
    x -> if(size(x.w) = 0, x.w, transform(
      transform(array(struct(x.g % size(x.w) AS a, 1 + (size(x.w) - x.g % size(x.w)) div (3 + x.g % 8) AS p)),
        y -> transform(sequence(0, size(x.w) - 1),
          i -> x.w[CAST(if(i < y.a, i, y.a + (i - y.a) % y.p) AS INT)])),
      z -> array_join(z, ' '))))), ' ')
ELSE text END"""
# Most periods first; of equals the first start, then the shortest period.
_BY_PERIODS = """
array_sort(runs, (l, r) -> CASE
  WHEN l.length * r.period <> r.length * l.period THEN if(l.length * r.period > r.length * l.period, -1, 1)
  WHEN l.start <> r.start THEN if(l.start < r.start, -1, 1)
  ELSE CAST(sign(l.period - r.period) AS INT) END)"""


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs with a period in every document, and digests of them and of what is left."""
    texts = table(spark, sf_dir, "documents").select("doc_id", F.expr(_WITH_PERIODS).alias("text"))
    found = periodic_runs.find_runs(texts)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    best = F.get(F.expr(_BY_PERIODS), F.lit(0))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first components of all of them, whitened."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").where(
        "size(embedding) > 0 AND forall(embedding, c -> c IS NOT NULL AND abs(c) < double('Infinity'))"
    )
    # Beyond 2^42 an entry counts as that, so that whole numbers hold it.
    x = "transform(embedding, c -> floor(1024 * greatest(least(double(c), 4398046511104D), -4398046511104D)) + 100000)"
    rows = rows.select("vec_id", F.expr(x).alias("x"))
    fitted = whitening.fit(rows, "x")
    whitened = store(whitening.whiten(rows, fitted, "x"), "whitened")
    error = whitening.identity_error(whitened, fitted)
    n, sums, explained = 0, [], []
    if fitted:
        n, sums = fitted.n, fitted.sums
        explained = [e / fitted.trace if fitted.trace else None for e in fitted.values.tolist()]
    totals = F.lit([str(s) for s in sums]).cast("array<bigint>")
    apart = F.zip_with("x", totals, lambda c, s: F.try_subtract(F.try_multiply(F.lit(n).cast("bigint"), c), s))
    # A deviation that no long can hold is null.
    deviation = F.aggregate(
        apart, F.lit(0).cast("bigint"), lambda total, c: F.try_add(total, F.try_multiply(c, c))
    )
    # Once per vector, not per component.
    once = whitened.select("vec_id", deviation.alias("deviation"), "whitened")
    each = once.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(explained).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as examples, and what is read back from them."""
    own = "</s>[INST] ok [/INST]"
    said = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(own).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    examples = chat_format.format_examples(rows.unionByName(said))
    reply = chat_format.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))
    found = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.sort_array(F.collect_list(F.struct("example", reply.alias("reply")))).alias("replies"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    read = found.select(
        "conv_id",
        chat_format.turns_of(F.col("text")).alias("turns"),
        F.array_join("replies.reply", "").alias("trained"),
        "formatted_chars",
    )
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.char_length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_warc_index": op3_warc_index,
    "op4_source_mixing": op4_source_mixing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_url_filters": op7_url_filters,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLES = {
    # For pages of the form of the test tables: one article of titles and paragraphs, in which
    # no subtree can be a template.
    "op1_html_extraction": r"""
WITH blocks AS (
  SELECT page_id, url, string_split_regex(replace(regexp_replace(
           regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '<br>', ' '),
         '</?(?:p|h1)>') AS b
  FROM pages),
texts AS (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(b, lambda x: trim(regexp_replace(
           replace(replace(replace(x, '&quot;', '"'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))),
         lambda x: x <> ''), chr(10) || chr(10)), '') AS text
  FROM blocks)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts""",
    "op3_warc_index": r"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
found AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first
  FROM payloads)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(x, (i // 4 * 5 + 1)::BIGINT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::BIGINT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM found""",
    "op4_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws(':', doc_id::VARCHAR, '7')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
rated AS (
  SELECT source, source_size, 3 * source_size AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sources),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k,
         sum(source_size) OVER () - coalesce(sum(cap) OVER (
           ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (
           ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM rated),
level AS (SELECT rest, weights FROM levels WHERE cap * weights >= rest * weight ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN cap * level.weights < level.rest * weight THEN cap::DOUBLE
              ELSE level.rest::DOUBLE * weight / level.weights::DOUBLE END AS target
  FROM rated, level),
placed AS (
  SELECT doc_id, size, source_size, target,
         sum(size) OVER (PARTITION BY sized.source ORDER BY key) - size AS before,
         least(floor(target + 0.5)::BIGINT, 3 * source_size) AS budget
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size * size + greatest(0, least(size, budget % source_size - before)))::BIGINT
       END AS taken
FROM placed""",
    "op10_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lined AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows JOIN twice USING (r, g)) GROUP BY r),
counted AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(t, '[#*$%&|<>]')) - len(regexp_extract_all(t, '\$[0-9]')) - len(regexp_extract_all(t, '[0-9]%'))
           - coalesce(list_sum(list_transform(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*\|')),
                                              lambda x: len(regexp_extract_all(x, '\|')))), 0) AS odd_signs,
         len(regexp_extract_all(t, '[\x{0e00}-\x{0fff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}]')) AS alone,
         len(regexp_extract_all(t, '[A-Z]')) AS upper_letters,
         len(regexp_extract_all(t, '[A-Za-z]')) AS letters,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM d JOIN lined USING (r) LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * odd_signs > word_chars
            OR (letters >= 20 AND 10 * upper_letters > 6 * letters)
            OR 10 * n_stutters > 3 * n_words
            OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)
            OR word_chars < 2 * n_words OR (word_chars > 25 * n_words AND 2 * alone <= word_chars)) AS kept
FROM judged""",
    # START, MESSAGE and END of the template have 9, 11 and 7 characters; each control string has one more.
    "op13_chat_formatting": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         sum(27 + length(role) + length(text)
             + len(regexp_extract_all(role || ' ' || text, '[<\[]\\*(?:\||/?s>|/?INST\])'))) OVER w AS chars
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
joined AS (
  SELECT conv_id, n_turns::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS spoken,
         coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '') AS trained,
         sum(chars) FILTER (WHERE role = 'assistant' OR k = n_turns) AS chars
  FROM numbered GROUP BY conv_id, n_turns)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, length(trained)::BIGINT AS loss_chars,
       sha256(trained) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM joined""",
}
