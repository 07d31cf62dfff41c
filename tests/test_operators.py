import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.operators import batching, history, hits, joins, neighbours, positions, posts, profile, terms, topics
from newsloom.operators.validation import split_valid


def test_validation(spark):
    df = spark.createDataFrame(
        [(1, "a", ["k"]), (2, None, ["k"]), (3, "", []), (4, "b", None), (5, "c", ["k", None])],
        "i int, s string, l array<string>",
    )
    valid, rejected = split_valid(df, ["s"], ["l"])
    assert [r[0] for r in rows(valid)] == [1, 3]
    assert {r["i"]: r["reject_reason"] for r in rejected.collect()} == {2: "s", 4: "l", 5: "l"}


# positions and batches


def test_positions_in_groups(spark):
    """A third of all rows in one group, some keys null."""
    rnd = random.Random(1)
    data = [(rnd.choice(["hot", f"k{i % 40}", None]), i) for i in range(3000)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k string, i int").repartition(7)
    want, seen = set(), defaultdict(int)
    for k, i in sorted(data, key=lambda r: r[1]):
        want.add((k, i, seen[k]))
        seen[k] += 1
    placed = positions.group_positions(df, ["k"], ["i"])
    assert {tuple(r) for r in placed.collect()} == want


@pytest.mark.parametrize("n", [0, 1, 200, 201, 1001])
def test_batches(spark, n):
    df = spark.range(n, numPartitions=5).select((F.lit(n) - F.col("id")).alias("id"), F.lit("x").alias("wide"))
    batched = batching.assign_batches(df, ["id"])
    sizes = {r["batch_no"]: r["count"] for r in batched.groupBy("batch_no").count().collect()}
    assert sizes == {b: min(200, n - 200 * b) for b in range(-(-n // 200))}
    assert [r["id"] for r in batched.orderBy("pos").collect()] == list(range(1, n + 1))


def test_positions_need_a_key_per_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "i int, s string")
    with pytest.raises(Exception, match="do not identify a row"):
        positions.positions_joined(df, ["i"]).collect()


def fold(tokens, budget, count_opener):
    chunks, chunk, running = [], 0, 0
    for i, t in enumerate(tokens):
        if running + t > budget and not (count_opener and i == 0):
            chunk, running = chunk + 1, t if count_opener else 0
        else:
            running += t
        chunks.append(chunk)
    return chunks


def test_fold_by_hand():
    assert fold([3000, 4000, 2000, 5000, 9000, 100, 8000], 8000, False) == [0, 0, 1, 1, 2, 2, 3]


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.integers(0, 60), min_size=1, max_size=60),
    st.sampled_from([1, 10, 50]),
    st.integers(1, 15),
    st.integers(1, 4),
    st.booleans(),
)
def test_blocks_chain_like_the_fold(tokens, budget, block, stretch, count_opener):
    import pandas as pd

    blocks = [np.array(tokens[k:k + block]) for k in range(0, len(tokens), block)]
    pieces = []
    for n, part in enumerate(blocks):
        table = batching.block_pieces(part, budget, count_opener, count_opener and n == 0)
        pieces.append(table.assign(__block=n))
    pieces = pd.concat(pieces)
    starts = batching.chain(pieces, "__block", 0, 0)
    # The same by stretches of blocks.
    pieces["__stretch"] = pieces["__block"] // stretch
    joined = [
        batching.join_pieces(p, "__block").assign(__stretch=n) for n, p in pieces.groupby("__stretch")
    ]
    before = batching.chain(pd.concat(joined), "__stretch", 0, 0)
    by_stretch = [
        batching.chain(p, "__block", before["__running"].iloc[n], before["__opened"].iloc[n])
        for n, p in pieces.groupby("__stretch")
    ]
    assert pd.concat(by_stretch).values.tolist() == starts.values.tolist()
    found = []
    for n, part in enumerate(blocks):
        opened = starts["__opened"].iloc[n]
        running = int(starts["__running"].iloc[n])
        numbered = batching.number_block(part, budget, count_opener, running, count_opener and n == 0)
        found += list(numbered + opened)
    assert found == fold(tokens, budget, count_opener)


@pytest.mark.parametrize("count_opener", [False, True])
def test_token_chunks(spark, count_opener):
    rnd = random.Random(3)
    data = [(rnd.choice(["hot", "hot", "b", None]), i, rnd.choice([0, 50, 900, 3000, 9000])) for i in range(900)]
    df = spark.createDataFrame(data, "run string, i int, token_count int").repartition(5)
    want = set()
    for run in ("hot", "b", None):
        group = [r for r in data if r[0] == run]
        want |= {(*r, c) for r, c in zip(group, fold([r[2] for r in group], 8000, count_opener))}
    found = batching.token_chunks(df, ["run"], ["i"], count_opener=count_opener, block_rows=37, chain_blocks=3)
    assert {tuple(r) for r in found.collect()} == want


# dedupe


def test_new_articles(spark):
    schema = "id int, article_title string, source_name string, run_id string"
    past = spark.createDataFrame(
        [(1, "a", "s", "RUNID_1"), (2, None, "s", "RUNID_1"), (3, "later", "s", "RUNID_9"),
         (4, "", "s", "RUNID_2"), (5, "own", "s", "RUNID_3"), (6, "x", None, "RUNID_1")],
        schema,
    )
    now = spark.createDataFrame(
        [(10, "a", "s", "RUNID_3"), (11, "a", "t", "RUNID_3"), (12, None, "s", "RUNID_3"),
         (13, "later", "s", "RUNID_3"), (14, "", "s", "RUNID_3"), (15, "own", "s", "RUNID_3"),
         (16, "twice", "s", "RUNID_3"), (17, "twice", "s", "RUNID_3"), (18, "x", None, "RUNID_3"),
         (19, None, None, "RUNID_3")],
        schema,
    )
    for prune in (False, True):
        kept = history.new_articles(now, past, prune_history=prune)
        assert [r[0] for r in rows(kept)] == [11, 15, 16, 17, 19]
    titles = history.new_articles(now, past, ["article_title"])
    assert [r[0] for r in rows(titles)] == [15, 16, 17]


def test_a_hot_key_is_split(spark):
    """A third of all articles has no title; the join splits them over tasks."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        text = F.col("id").cast("string")
        articles = spark.range(0, 90000, 1, 8).select(
            F.concat(F.lit("RUNID_"), (F.col("id") % 4).cast("string")).alias("run_id"),
            F.when(F.col("id") % 3 > 0, text).alias("article_title"),
            F.lit("s").alias("source_name"),
            F.sha2(text, 256).alias("body"),
        )
        kept = history.new_articles(articles, articles).agg(F.max("body"), F.count("*"))
        assert kept.collect()[0][1] == 60000
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_last_per_key_and_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "i int, k string")
    assert [r[0] for r in rows(history.last_per_key(df, ["k"], "i"))] == [2, 3, 5]
    assert [r[0] for r in rows(history.later_copies(df, "k", "i"))] == [3, 5]
    assert rows(history.duplicate_keys(df, ["k"])) == [("a", 2), (None, 2)]


# hits


HITS = [
    ("ana", "q1", None, "https://s.com/1", "Site A", 0),
    ("luc", "q2", "Title", "https://s.com/1", None, 1),
    ("ana", "q1", "Other", "https://s.com/1", "Site A", 2),
    ("ana", "q3", "T", None, "Site B", 3),
    ("eva", "q4", "T", "https://t.com/x/y", None, 4),
]


def test_fold_hits(spark):
    df = spark.createDataFrame(HITS, "persona string, query string, title string, url string, source string, ord int")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("date", "body", "image")})
    folded = hits.fold_hits(df)
    assert rows(folded.select("url", "title", "source")) == [
        ("https://s.com/1", "Title", "Site A"), ("https://t.com/x/y", "T", None),
    ]
    assert rows(hits.hit_searches(df)) == [
        ("https://s.com/1", 0, "ana", "q1"), ("https://s.com/1", 1, "luc", "q2"),
        ("https://s.com/1", 2, "ana", "q1"), ("https://t.com/x/y", 4, "eva", "q4"),
    ]
    articles = hits.hits_to_articles(folded, "RUNID_1", "now")
    assert {r["source_url"] for r in articles.collect()} == {"https://s.com"}
    assert [r["query_original_personas"] for r in hits.article_searches(df, articles).orderBy("ord").collect()] == ["ana", "luc", "ana"]


def test_a_url_of_very_many_hits_is_one_article(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("ord"), F.lit("https://s.com/1").alias("url"), F.lit("p").alias("persona"),
        F.col("id").cast("string").alias("query"), F.lit("t").alias("title"), F.lit("s").alias("source"),
        *[F.lit("x").alias(c) for c in ("date", "body", "image")],
    )
    articles = hits.hits_to_articles(hits.fold_hits(df), "RUNID_1", "now")
    assert articles.count() == 1
    assert hits.article_searches(df, articles).count() == 30_000


# joins


def test_attach_raw(spark):
    outputs = spark.createDataFrame(
        [("a", "m", "R1", "rel", {"P": 2}, "es"), ("b", "m", "R1", "rel", {"P": 2}, "en"),
         ("c", "m", "R1", "rel", {"P": 1}, "es"), ("lost", "m", "R1", "rel", {"P": 2}, "es")],
        "article_id string, model string, run_id string, task_name string, relevance map<string,int>, "
        "article_language string",
    )
    raw = spark.createDataFrame(
        [("a", "crawler", "parse", "R1", "ca", "jina", 0), ("b", None, None, "R0", None, "ddgs", 1),
         ("c", "crawler", "parse", "R1", "es", "jina", 2), ("a", "crawler", "parse", "R7", "fr", "jina", 3)],
        "article_id string, model string, task_name string, run_id string, article_language string, "
        "crawling_source string, ord int",
    )
    found = {r["article_id"]: r for r in joins.relevant_articles(outputs, raw, "ord").collect()}
    assert set(found) == {"a", "b"}
    a, b = found["a"], found["b"]
    assert (a["model"], a["task_name"], a["run_id"], a["article_language"]) == ("m", "rel", "R7", "fr")
    assert (b["model"], b["task_name"], b["run_id"], b["article_language"]) == ("m", "rel", "R0", "en")
    assert rows(joins.unmatched(outputs, raw).select("article_id")) == [("lost",)]


def test_invalid_content_goes_and_unjudged_stays(spark):
    content = spark.createDataFrame([("R1", "a"), ("R1", "b"), ("R1", "c"), ("R2", "a")], "run_id string, article_id string")
    verdicts = spark.createDataFrame(
        [("R1", "a", False), ("R1", "b", True), ("R1", "c", None)],
        "run_id string, article_id string, validity boolean",
    )
    assert rows(joins.drop_invalid(content, verdicts)) == [("R1", "b"), ("R1", "c"), ("R2", "a")]


def test_merge_suffixes(spark):
    a = spark.createDataFrame([(1, "x", 5)], "id int, run string, n int")
    b = spark.createDataFrame([(1, "y", 6), (1, "z", 7)], "id int, run string, m int")
    merged = joins.merge_inner(a, b, "id")
    assert merged.columns == ["id", "run_x", "n", "run_y", "m"]
    assert merged.count() == 2


# profiles and status


def test_profile(spark):
    posts_ = spark.createDataFrame(
        [("ana", "https://a.com/1"), ("ana", "https://a.com/2"), ("ana", None), ("luc", None)],
        "perfil string, link string",
    )
    counts = profile.source_counts(posts_)
    assert rows(counts) == [("ana", "https://a.com", 2)]
    assert rows(profile.count_present(posts_, "perfil", "link")) == [("ana", 2), ("luc", 0)]
    assert rows(profile.value_counts(posts_, "link")) == [("https://a.com/1", 1), ("https://a.com/2", 1)]


def test_distinct_values(spark):
    df = spark.range(50).select(F.lit("k").alias("k"), F.format_string("v%02d", F.col("id") % 25).alias("v"))
    found = rows(profile.distinct_values(df, "k", "v"))
    assert found == sorted([("k", i, f"v{i:02d}") for i in range(25)], key=repr)


BATCHES = "batch_id string, status string, output string, error string"


@pytest.mark.parametrize(
    "batches, status, wait",
    [
        ([], "ALL_ERROR_END", None),
        ([("a", "completed", "x", None)], "ALL_COMPLETED_CONTINUE", None),
        ([("a", "completed", "x", "e")], "ALL_COMPLETED_CONTINUE", None),
        ([("a", "completed", " \n", "e"), ("b", "completed", None, None)], "ALL_ERROR_END", None),
        ([("a", "completed", None, None)], "ALL_ERROR_END", None),
        ([("a", "in_progress", None, None), ("b", None, None, None), ("c", "completed", "x", None)], "WAIT", 240),
        ([("a", "failed", None, "e")], "WAIT", 120),
    ],
)
def test_batch_status(spark, batches, status, wait):
    row = profile.batch_status(spark.createDataFrame(batches, BATCHES)).first()
    assert (row["status"], row["wait_time"]) == (status, wait)


def test_latest_run(spark):
    ledger = spark.createDataFrame(
        [("RUNID_9", "success", 0), ("RUNID_10", "failed", 1), ("RUNID_10", None, 2)], "RUNID string, status string, ord int"
    )
    row = profile.latest_run(ledger, "ord").first()
    assert (row["RUNID"], row["status"]) == ("RUNID_10", "unknown")


def test_latest_article_and_pick(spark):
    df = spark.createDataFrame([("a", None), ("b", "2024-01-02"), ("c", "2024-01-02")], "article_id string, publish_date string")
    assert profile.latest_article(df).first()["article_id"] == "b"
    assert profile.pick(df, [F.asc("article_id")], 2).first()["article_id"] == "c"
    assert profile.pick(df, [F.asc("article_id")], 3).first() is None


# vectors


def nearest_by_hand(corpus, queries, k):
    out = set()
    for q, qv in queries:
        ranked = sorted((round(float(((np.float64(v) - qv) ** 2).sum()), 6), i) for i, v in corpus)
        out |= {(q, i, d, n + 1) for n, (d, i) in enumerate(ranked[:k])}
    return out


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_nearest(spark, limit, monkeypatch):
    """Copies of one vector make many ties; the lower ids win."""
    monkeypatch.setattr(neighbours, "QUERY_BLOCK_BYTES", 3 * 8 * 8)
    monkeypatch.setattr(neighbours, "CORPUS_BLOCK_BYTES", 50 * 8 * 8)
    rnd = np.random.default_rng(0)
    base = rnd.integers(-3, 4, (60, 8)).astype(np.float32)
    corpus = [(f"a{i:03d}", base[i % 60 if i % 3 else 0]) for i in range(180)]
    queries = [(i, rnd.integers(-3, 4, 8).astype(np.float64)) for i in range(7)]
    c = spark.createDataFrame([(i, v.tolist()) for i, v in corpus], "id string, embedding array<float>").repartition(5)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in queries], "qid int, q array<double>")
    found = neighbours.nearest(c, q, "id", "qid", query_vector="q", k=5, max_query_bytes=limit)
    assert {tuple(r) for r in found.collect()} == nearest_by_hand(corpus, queries, 5)


def test_tasks_of_an_all_pairs_search_are_bounded(spark, monkeypatch):
    """Neither many vectors nor long ones make a task longer; the smaller blocks find the same."""
    for n, length in ((100_000, 64), (600_000, 64), (600_000, 768), (50, 8)):
        q, c = neighbours.block_counts(n, n, length, neighbours.QUERY_BLOCK_BYTES, neighbours.CORPUS_BLOCK_BYTES)
        assert (n / q) * (n / c) * length <= 1.1 * neighbours.BLOCK_WORK
        assert (n / q) * length * 8 <= 1.1 * neighbours.QUERY_BLOCK_BYTES
    assert (q, c) == (1, 1)
    draw = np.random.default_rng(3)
    data = [(f"v{i:03d}", row) for i, row in enumerate(draw.integers(0, 3, (300, 4)).astype(float).tolist())]
    df = spark.createDataFrame(data, "id string, v array<double>")
    queries = df.select(F.col("id").alias("q"), "v")
    monkeypatch.setattr(neighbours, "BLOCK_WORK", 4 * 5000)
    monkeypatch.setattr(neighbours, "QUERY_PIECE", 7)
    monkeypatch.setattr(neighbours, "CORPUS_PIECE", 11)
    assert min(neighbours.block_counts(300, 300, 4, 1 << 20, 1 << 20)) > 2
    found = {tuple(r) for r in neighbours.nearest(df, queries, "id", "q", "v", k=6, max_query_bytes=0).collect()}
    want = set()
    for name, q in data:
        best = sorted((sum((a - b) ** 2 for a, b in zip(q, v)), i) for i, v in data)[:6]
        want |= {(name, i, d, rank) for rank, (d, i) in enumerate(best, 1)}
    assert found == want


def test_nearest_with_few_rows_or_no_queries(spark):
    c = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "id int, embedding array<float>")
    q = spark.createDataFrame([(1, [0.0, 0.0])], "qid int, q array<double>")
    found = neighbours.nearest(c, q, "id", "qid", query_vector="q", k=5)
    assert rows(found) == [(1, 1, 0.0, 1), (1, 2, 25.0, 2)]
    assert neighbours.nearest(c, q.where("qid > 1"), "id", "qid", query_vector="q").count() == 0


def test_topics(spark):
    rnd = np.random.default_rng(1)
    points = [(i, (np.eye(8)[i % 4] * 10 + rnd.normal(0, 0.1, 8)).tolist()) for i in range(200)]
    df = spark.createDataFrame(points, "id int, embedding array<float>")
    found = topics.assign_topics(df, k=4).collect()
    assert len({(r["id"] % 4, r["topic"]) for r in found}) == 4


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_topics_of_few_different_rows(spark, n):
    df = spark.createDataFrame(
        [(i, [float(i % n), 1.0]) for i in range(6 if n else 0)], "id int, embedding array<float>"
    )
    found = topics.assign_topics(df).collect()
    assert len({(r["id"] % n, r["topic"]) for r in found}) == n


def test_projection(spark):
    rnd = np.random.default_rng(2)
    points = rnd.normal(5, 1, (100, 6)) * np.array([9, 5, 3, 1, 0.5, 0.1])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, embedding array<double>")
    found = np.array([[r["x"], r["y"], r["z"]] for r in topics.project(df).orderBy("id").collect()])
    assert np.allclose(found.mean(axis=0), 0, atol=1e-8)
    u, s, _ = np.linalg.svd(points - points.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(found), np.abs(u[:, :3] * s[:3]), atol=1e-6)


def test_embedder_treats_queries_and_corpus_alike(spark):
    df = spark.createDataFrame([(1, "data and beer"), (2, None), (3, "Data, and BEER")], "id int, t string")
    for embed in (terms.text_embedder(), terms.text_embedder(df, "t")):
        found = {r["id"]: r["v"] for r in embed(df, "t", "v").collect()}
        assert found[1] == found[3]
        assert len(found[2]) == 256 and not any(found[2])


# posts


def people(spark):
    return spark.createDataFrame([("ANA", "Runs data."), ("LUC", None)], "name string, linkedin_bio string")


def test_seeded_sample(spark):
    df = spark.createDataFrame([("a" if i % 4 else "b", i) for i in range(100)], "k string, i int")
    first, again = (rows(posts.seeded_sample(df.repartition(n), ["k"], "i", 5, seed=1)) for n in (2, 7))
    assert first == again
    assert len(first) == 10
    assert first != rows(posts.seeded_sample(df, ["k"], "i", 5, seed=2))
    assert posts.seeded_sample(df, ["k"], "i", 80).count() == 100


def test_prompts(spark):
    articles = spark.createDataFrame(
        [("1", "T1", "es", "S1", "u1", {"ANA": 2, "LUC": 1}), ("2", "T2", "en", "S2", "u2", {"ANA": 2, "LUC": 2}),
         ("3", "T3", "en", "S3", "u3", {"ANA": 0}), ("4", "T4", "en", "S4", "u4", {"NOBODY": 2})],
        "article_id string, article_title string, article_language string, summary string, article_url string, "
        "relevance map<string,int>",
    )
    past = spark.createDataFrame([("ANA", "p1", 1), ("ANA", "p2", 2), ("ANA", None, 3)], "perfil string, copy string, i int")
    found = {(r["perfil"], r["article_id"]): r for r in posts.post_prompts(articles, people(spark), past, "i").collect()}
    assert set(found) == {("ANA", "1"), ("ANA", "2"), ("LUC", "2")}
    one = found["ANA", "1"]
    assert one["user_content"] == "T1\nS1"
    assert "Runs data." in one["system_content"]
    assert "Example 1:\np1\n\nExample 2:\np2" in one["system_content"]
    assert one["system_content"].endswith("Language of the post: es")
    assert "T2" not in one["system_content"]
    assert "Earlier posts" not in found["LUC", "2"]["system_content"]


def test_call_to_action_is_in_about_half(spark):
    chosen = spark.range(2000).where(posts.coin(F.col("id"), 3)).count()
    assert 850 < chosen < 1150


def test_article_message_is_json(spark):
    import json

    df = spark.createDataFrame([("s", 'T "1"', None)], "source_name string, article_title string, summary string")
    message = df.select(posts.article_user_message(*df.columns).alias("m")).first()["m"]
    head, _, body = message.partition("\n\n")
    assert head == "The article:"
    assert json.loads(body) == {"source_name": "s", "article_title": 'T "1"', "summary": None}


def test_pairs_of_unlisted_personas_are_reported(spark):
    articles = spark.createDataFrame([("a", {"P": 2, "Q": 2, "R": 1})], "article_id string, relevance map<string,int>")
    people = spark.createDataFrame([("P",)], "name string")
    assert rows(posts.unlisted_pairs(articles, people)) == [("a", "Q", "persona is not listed")]


def test_faulty_vectors_do_not_hide_others(spark):
    nan = float("nan")
    corpus = spark.createDataFrame(
        [(1, [0.0, 1.0]), (2, [nan, 0.0]), (3, [1.0]), (4, [0.0, 0.0, 0.0]), (5, None), (6, [5.0, 5.0]), (7, [None, 1.0])],
        "id int, embedding array<double>",
    ).coalesce(1)
    queries = spark.createDataFrame([(0, [0.0, 0.0]), (1, [nan, 0.0])], "q int, embedding array<double>")
    for most in (1 << 20, 0):
        found = neighbours.nearest(corpus, queries, "id", "q", k=5, max_query_bytes=most)
        assert rows(found.select("q", "id", "distance")) == [(0, 1, 1.0), (0, 6, 50.0)]
    assert rows(neighbours.unusable(corpus, "id", length=2)) == [
        (2, "not finite"), (3, "other length"), (4, "other length"), (5, "no vector"), (7, "not finite"),
    ]
    mixed = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0])], "q int, embedding array<double>")
    with pytest.raises(ValueError):
        neighbours.nearest(corpus, mixed, "id", "q")


def test_text_vectors_and_search_agree_with_brute_force(spark):
    """Hashed words weighted by rarity at unit length, and the documents nearest to each query."""
    import hashlib
    import math

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")

    def counts(value):
        words = regex.findall(r"[\p{L}\p{N}]+", value.lower())
        return Counter(int(hashlib.md5(w.encode()).hexdigest()[:4], 16) for w in words)

    tf = {r.doc_id: counts(r.text) for r in docs.collect()}
    holds = Counter(b for c in tf.values() for b in c)

    def vector(count):
        v = np.zeros(64)
        for b, n in count.items():
            v[b % 64] += n * math.log((len(tf) + 1) / (holds[b] + 1))
        return v / (np.linalg.norm(v) or 1)

    embed = terms.text_embedder(docs, "text", 64)
    found = {r.doc_id: np.array(r.v) for r in embed(docs, "text", "v").select("doc_id", "v").collect()}
    want = {i: vector(c) for i, c in tf.items()}
    assert all(np.allclose(found[i], want[i], atol=1e-6) for i in want)
    queries = embed(items, "text", "query").select("item_id", "query")
    nearest = neighbours.nearest(embed(docs, "text", "v"), queries, "doc_id", "item_id", "v", "query", k=3)
    got = {(r.item_id, r["rank"]): r.distance for r in nearest.collect()}
    for item in items.collect():
        own = vector(counts(item.text))
        best = sorted(float(((own - v) ** 2).sum()) for v in want.values())[:3]
        assert np.allclose([got[item.item_id, k + 1] for k in range(3)], best, atol=1e-5)


def test_best_sentences():
    weight = np.arange(terms.BUCKETS)
    # One word each: the rarest, then the next rare that has not been said, in text order.
    buckets, ends = np.array([5, 9, 9, 7, 1, 2]), np.arange(1, 7)
    assert terms.best_sentences(buckets, ends, weight) == [0, 1, 3]
    assert terms.best_sentences(buckets, ends, weight * 0) == [0, 1, 2]
    assert terms.best_sentences(buckets[:2], ends[:2], weight) == [0, 1]
    assert terms.best_sentences(np.array([], int), np.array([], int), weight) == []
    # Eight of many, also from the end of a long text.
    long = np.arange(2000)
    assert terms.best_sentences(long, long + 1, weight) == list(range(1992, 2000))


def test_scored_summary_of_edge_texts(spark):
    texts = [(1, None), (2, ""), (3, "..."), (4, "One.  Two! "), (5, "- Odd - signs. No"), (6, "A b. " * 3 + "Rare words here. " + "A b. " * 3)]
    df = spark.createDataFrame(texts, "id int, t string")
    counts = terms.document_counts(df, "t")
    found = {r.id: r.s for r in df.select("id", terms.scored_summary(F.col("t"), counts).alias("s")).collect()}
    assert found == {1: None, 2: "", 3: "", 4: "One. Two!", 5: "- Odd - signs. No", 6: "A b. A b. Rare words here."}
    assert terms.counts_array(counts)[0] == 6
    empty = df.limit(0)
    assert terms.document_counts(empty, "t").count() == 0
    assert empty.select(terms.scored_summary(F.col("t"), terms.document_counts(empty, "t")).alias("s")).count() == 0
