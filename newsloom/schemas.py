"""Table schemas, as DDL. Every read names its schema; nothing is inferred."""

SOURCES = "source_name string, url string"

KEYWORDS = "persona string, keyword string"

SOURCE_RAW_CONTENT = "url string, name string, raw_content string, crawl_time string"

RAW_ARTICLES_CRAWLED = (
    "model string, run_id string, task_name string, source_name string, article_id string, "
    "article_title string, article_url string, article_keywords array<string>, "
    "article_language string, crawled_at string"
)

SEARCH_HITS = (
    "persona string, query string, date string, title string, body string, url string, "
    "image string, source string"
)

RAW_ARTICLES_SEARCHED = (
    "run_id string, source_name string, source_url string, article_id string, article_date string, "
    "article_title string, article_url string, article_body string, article_image_url string, "
    "article_language string, crawled_at string"
)

# Who found a searched article, by what query; any number of rows per article.
ARTICLE_SEARCHES = (
    "run_id string, article_id string, ord bigint, query_original_personas string, "
    "ddgs_search_query string"
)

RAW_ARTICLES = (
    "model string, run_id string, task_name string, source_name string, source_url string, "
    "article_id string, article_date string, article_title string, article_url string, "
    "article_body string, article_image_url string, article_keywords array<string>, "
    "article_language string, crawled_at string, crawling_source string"
)

# `relevance` once was one number per article; both forms are kept as typed columns.
RELEVANT_ARTICLES = RAW_ARTICLES + ", relevance map<string,int>, relevance_scalar int"

TASK_RESPONSE = (
    "custom_id string, response struct<body: struct<model: string, "
    "choices: array<struct<message: struct<content: string>>>>>"
)

BATCH_STATUS = "batch_id string, status string, output string, error string"

ARTICLE_CONTENT = "article_id string, content string, title string, publish_date string"

SUMMARIES = "model string, summary string, article_id string, run_id string, task_name string"

EMBEDDINGS = "article_id string, summary_embedding array<float>, embedding_model string"

RUNS_METADATA = (
    "RUNID string, status string, run_location string, run_duration double, "
    "pipeline_finish_time string, failed_step string, error string"
)

PERSONAS = "name string, role string, linkedin_bio string, linkedin_job_description string"

PERSONA_KEYWORDS = "persona string, keywords array<string>"

PERSONA_SOURCES = "persona string, sources array<string>"

PAST_POSTS = "perfil string, copy string, link string"

GENERATED_POSTS = (
    "perfil string, copy string, article_title string, article_language string, "
    "summary string, article_url string"
)

# Columns a record must hold to be valid: (plain columns, array columns).
REQUIRED = {
    "sources": (["url", "source_name"], []),
    "source_raw_content": (["url", "name", "raw_content", "crawl_time"], []),
    "raw_articles_crawled": (
        ["model", "run_id", "task_name", "source_name", "article_id", "article_title",
         "article_url", "article_language", "crawled_at"],
        ["article_keywords"],
    ),
    "raw_articles_searched": (
        ["run_id", "source_name", "source_url", "article_id", "article_date", "article_title",
         "article_url", "article_body", "article_image_url", "article_language", "crawled_at"],
        [],
    ),
}

# What the two kinds of crawl are called in `crawling_source`.
CRAWLED = "jina"
SEARCHED = "ddgs"
