"""Run the curation of one run with the built-in models.

usage: python -m newsloom --workspace DIR --personas personas.json --keywords keywords.json
                          [--runid RUNID_7] [--resume_step STEP] [--run_location NAME]
                          [--sources urls.txt] [--pages pages.json] [--hits hits.json]
                          [--batch_model NAME] [--search TEXT]

Without --runid it names the last run and its status. personas.json is a list of objects with
name and role; keywords.json maps a name to a list of keywords (or
--keyword_table: Parquet with persona and keyword). --sources
registers the URLs of a text file, --pages and --hits take in the run's crawled pages and search
hits, each a JSON array.

With --batch_model requests are written as files under exchange/requests of the workspace; the
run ends as waiting, and goes on with --resume_step open once answer files lie under
exchange/answers. The exit code then is 3. --search prints the articles nearest to a text.
"""

import argparse
import json
import logging
import sys

from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.profile import latest_run
from newsloom.plans import curation
from newsloom.session import build_session
from newsloom.sources.readers import read_json_array


def main() -> int:
    parser = argparse.ArgumentParser(prog="newsloom", description="Run the curation of one run.")
    parser.add_argument("--workspace", required=True)
    parser.add_argument("--personas")
    parser.add_argument("--keywords")
    parser.add_argument("--keyword_table")
    parser.add_argument("--runid")
    parser.add_argument("--resume_step")
    parser.add_argument("--run_location", default="local")
    parser.add_argument("--sources")
    parser.add_argument("--pages")
    parser.add_argument("--hits")
    parser.add_argument("--batch_model")
    parser.add_argument("--search")
    args = parser.parse_args()

    logging.basicConfig(level=logging.WARNING)
    logging.getLogger("newsloom").setLevel(logging.INFO)
    spark = build_session()
    ws = curation.Workspace(spark, args.workspace)
    if args.sources:
        curation.register_sources(ws, args.sources)
    if args.search:
        query = spark.createDataFrame([(1, args.search)], "query_id int, text string")
        for row in curation.search(ws, query).orderBy("rank").collect():
            print(f"{row['rank']}. {row['article_title']} ({row['distance']:.3f}) {row['article_url']}")
        return 0
    if args.runid is None:
        ledger = ws.read("runs_metadata", schemas.RUNS_METADATA, required=False)
        last = latest_run(ledger.withColumn("ord", F.col("pipeline_finish_time")), "ord").first()
        print("no runs yet" if last is None else f"last run: {last['RUNID']}, {last['status']}")
        return 2
    if not (args.personas and (args.keywords or args.keyword_table or args.batch_model)):
        parser.error("--personas, and --keywords, --keyword_table or --batch_model, are needed for a run")
    # One row per person, as many as the task can name in its instructions.
    people = [
        (p["name"], p["role"] or "")
        for p in read_json_array(spark, args.personas, schemas.PERSONAS).select("name", "role").collect()
    ]
    if args.batch_model:
        models = curation.batch_models(ws, args.runid, people, args.batch_model)
    else:
        if args.keyword_table:
            own = spark.read.schema(schemas.KEYWORDS).parquet(args.keyword_table)
        else:
            with open(args.keywords, encoding="utf-8-sig") as f:
                keywords = json.load(f)
            own = {name: keywords.get(name, []) for name, _ in people}
        models = curation.baseline_models(people, own, curation.past_counts(ws, args.runid))
    if args.pages:
        ws.ingest("source_raw_content", args.pages, schemas.SOURCE_RAW_CONTENT, args.runid)
    if args.hits:
        ws.ingest("search_hits", args.hits, schemas.SEARCH_HITS, args.runid)
    status = curation.run_curation(
        ws,
        args.runid,
        [name for name, _ in people],
        models,
        resume=args.resume_step,
        location=args.run_location,
    )
    print(f"{args.runid}: {status}")
    return {"success": 0, "waiting": 3}.get(status, 1)


if __name__ == "__main__":
    sys.exit(main())
