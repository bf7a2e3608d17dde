"""Command line: ``spark-submit`` or ``python -m jobsieve <job> ...``."""

import argparse
import importlib

from .operators import insights, training
from .operators.clean import drop_fields
from .plans.enrich import enrich_posts, extract_flat
from .plans.ingest import posts_from_pages
from .schemas import ENRICHED_POST
from .session import get_session
from .sources import readers, sinks
from .sources.dictionaries import Dictionaries
from .streaming import jobs


def _dictionaries(spark, args):
    paths = [args.title_aliases, args.skill_aliases, args.topics, args.services]
    if not any(paths):
        return Dictionaries(stop_terms=frozenset(args.stop_terms))
    if not all(paths):
        raise SystemExit("give all four dictionary files or none")
    return Dictionaries.load(spark, *paths, stop_terms=args.stop_terms)


def _finder(spark, args):
    """What finds skills: a lexicon table, the user's own labeller, or neither."""
    found = {}
    if args.lexicon:
        found["lexicon"] = spark.read.schema("term string, canonical string").json(args.lexicon)
    if args.labeler:
        module, _, name = args.labeler.partition(":")
        found["labeler"] = getattr(importlib.import_module(module), name)
    return found


def _insights(folder):
    """Where rows by key and signed counts lie."""
    return [f"{folder.rstrip('/')}/{name}" for name in ("state", "counts")]


def _payloads(spark, args):
    if args.brokers:
        options = {"kafka.bootstrap.servers": args.brokers}
        if args.min_partitions:
            options["minPartitions"] = str(args.min_partitions)
        return readers.read_posts_stream(spark, args.source, options)
    return readers.read_posts_stream(spark, args.source, fmt="text", schema="value string")


def pages(spark, args):
    posts = posts_from_pages(spark.read.parquet(args.listings), spark.read.parquet(args.details))
    sinks.write_posts_json(posts, args.out)


def ingest(spark, args):
    raw = "malformed"
    events = readers.read_landing_stream(spark, args.source, raw=raw)
    if args.brokers:
        forward = jobs.topic_sink(args.topic, **{"kafka.bootstrap.servers": args.brokers})
    else:
        forward = jobs.payload_version_sink(args.topic)
    if args.state_store:
        stream = jobs.dedupe_stream(drop_fields(events).drop(raw).filter("Job_ID IS NOT NULL"))
        sink = jobs.fan_out([jobs.upsert_sink(args.table), forward])
        jobs.start(stream, sink, args.progress, args.run, args.available_now).awaitTermination()
        return
    # Posts carry no arrival number of their own; the time of their file and their place in it give the order.
    place = {"arrived": "file_modification_time", "file": "file_path", "block": "file_block_start"}
    arrived = events.selectExpr("*", *[f"_metadata.{source} AS {name}" for name, source in place.items()])
    sink = jobs.ingest_sink(
        args.table,
        arrived.drop(raw).schema,
        order=list(place),
        forward=[lambda b, i, r: forward(b.drop(*place), i, r)],
        quarantine=args.quarantine or f"{args.table.rstrip('/')}-quarantine",
        raw=raw,
    )
    jobs.start(arrived, sink, args.progress, args.run, args.available_now).awaitTermination()


def enrich(spark, args):
    also = []
    if args.insights:
        also = [jobs.counts_sink(*_insights(args.insights), ENRICHED_POST, compact_every=args.compact_every)]
    query = jobs.run_stream(
        _payloads(spark, args), args.table, args.progress, _dictionaries(spark, args), args.run, args.available_now,
        quarantine=args.quarantine or f"{args.table.rstrip('/')}-quarantine", also=also, **_finder(spark, args),
    )
    query.awaitTermination()


def _posts(spark, args):
    """The posts of the source; what is no JSON goes to a folder beside the output."""
    read = readers.read_posts_json(spark, args.source, lines=args.lines, raw="_raw")
    rejects = read.filter("_raw IS NOT NULL").select("_raw")
    rejects.write.mode("overwrite").text(f"{args.out.rstrip('/')}-rejects")
    return readers.spread(read.filter("_raw IS NULL").drop("_raw"))


def extract(spark, args):
    posts = _posts(spark, args)
    sinks.write_posts_json(extract_flat(posts, _dictionaries(spark, args), **_finder(spark, args)), args.out)


def enrich_files(spark, args):
    posts = _posts(spark, args)
    enrich_posts(posts, _dictionaries(spark, args), **_finder(spark, args)).write.parquet(args.out)


def report(spark, args):
    state = sinks.merge_by_key(sinks.read_versions(spark, args.table, ENRICHED_POST))
    chosen = insights.facet(state, dict(f.split("=", 1) for f in args.filter))
    chosen = chosen.persist()
    insights.top_skills(chosen, args.k).write.mode("overwrite").json(f"{args.out}/top_skills")
    for column in ("Title", "Industry_type"):
        insights.skills_by(chosen, column, args.k).write.mode("overwrite").json(f"{args.out}/by_{column}")
    insights.category_counts(chosen).write.mode("overwrite").json(f"{args.out}/categories")
    insights.posts_over_time(chosen).write.mode("overwrite").json(f"{args.out}/months")


def insights_report(spark, args):
    """The figures of ``report`` from the counts that ``enrich --insights`` keeps, without reading posts."""
    _, folder = _insights(args.insights)
    schema = spark.createDataFrame([], "view string, `group` string, term string, n bigint").schema
    counts = insights.current_counts(sinks.read_versions(spark, folder, schema)).persist()

    def write(name, df):
        df.write.mode("overwrite").json(f"{args.out}/{name}")

    write("top_skills", insights.ranked_counts(counts, "skill", args.k).selectExpr("term AS skill", "posts"))
    for view, column in (("title", "Title"), ("industry", "Industry_type")):
        ranked = insights.ranked_counts(counts, view, args.k)
        write(f"by_{column}", ranked.selectExpr(f"`group` AS {column}", "term AS skill", "posts", "rank"))
    leaves = counts.filter("view IN ('category', 'service')")
    write("categories", leaves.withColumnRenamed("view", "kind"))
    write("months", counts.filter("view = 'period'").selectExpr("term AS period", "posts"))
    write("facets", counts.filter("view = 'facet'").selectExpr("`group` AS column", "term AS value", "posts"))
    counts.unpersist()


def score(spark, args):
    """Precision, recall and F1 of spans, from rows of gold label ids and class scores per position."""
    rows = spark.read.schema("labels array<int>, scores array<array<double>>").parquet(args.source)
    training.sequence_prf(training.argmax_labels(rows), mode=args.mode).write.mode("overwrite").json(args.out)


def compact(spark, args):
    if args.posts:
        sinks.compact_posts(spark, args.table, args.out)
    else:
        sinks.compact(spark, args.table, ENRICHED_POST, args.out)


def prepare(spark, args):
    good, rejects = readers.read_labelled_tokens(spark, args.source)
    sequences, unknown = training.split_unknown_labels(training.to_sequences(good, key="file"))
    vocab = spark.read.schema("token string, id int").json(args.vocab)
    split = training.split_train_val(sequences, "file", args.fraction, args.seed)
    encoded = training.encode_sequences(split, vocab, "file", keep=["split"])
    training.pad_sequences(encoded, sequences=split).write.partitionBy("split").parquet(f"{args.out}/encoded")
    bad = rejects.unionByName(unknown.selectExpr("file", "'unknown label' AS reason"))
    bad.write.json(f"{args.out}/rejects")
    training.load_report(sequences, bad).write.json(f"{args.out}/load_report")
    training.split_report(split).write.json(f"{args.out}/split_report")


def main(argv=None, spark=None):
    parser = argparse.ArgumentParser(prog="jobsieve")
    commands = parser.add_subparsers(required=True)

    def command(function, *required):
        p = commands.add_parser(function.__name__.replace("_", "-"), help=function.__doc__)
        for name in required:
            p.add_argument(f"--{name}", required=True)
        p.set_defaults(job=function)
        return p

    def dictionaries(p):
        for name in ("title-aliases", "skill-aliases", "topics", "services"):
            p.add_argument(f"--{name}")
        p.add_argument("--stop-terms", nargs="*", default=[])
        p.add_argument("--lexicon", help="JSON lines of term and canonical, of any number, in place of the dictionaries' terms")
        p.add_argument("--labeler", help="module:function from a text column to tagged tokens, in place of a lexicon")

    def stream(p):
        p.add_argument("--brokers", help="Kafka brokers; without them folders are used")
        p.add_argument("--run", type=int, default=0, help="a new number replays everything")
        p.add_argument("--available-now", action="store_true", help="stop when the source is read")
        p.add_argument("--quarantine", help="folder of malformed input and rows without a key, by default beside the table")

    command(pages, "listings", "details", "out")
    p = command(ingest, "source", "table", "topic", "progress")
    p.add_argument("--state-store", action="store_true", help="keep known keys in the state store, not the table")
    stream(p)
    p = command(enrich, "source", "table", "progress")
    p.add_argument("--min-partitions", type=int)
    p.add_argument("--insights", help="folder of counts that are kept up to date for insights-report")
    p.add_argument("--compact-every", type=int, default=100, help="batches after which its rows are put together")
    stream(p)
    dictionaries(p)
    for job in (extract, enrich_files):
        p = command(job, "source", "out")
        p.add_argument("--lines", action="store_true", help="the files hold JSON lines, as pages writes them")
        dictionaries(p)
    p = command(report, "table", "out")
    p.add_argument("--k", type=int, default=20)
    p.add_argument("--filter", nargs="*", default=[], help="column=value")
    p = command(insights_report, "insights", "out")
    p.add_argument("--k", type=int, default=20)
    p = command(score, "source", "out")
    p.add_argument("--mode", choices=["conll", "strict"], default="conll")
    p = command(compact, "table", "out")
    p.add_argument("--posts", action="store_true", help="the table is one of ingest, not of enrich")
    p = command(prepare, "source", "vocab", "out")
    p.add_argument("--fraction", type=float, default=0.2)
    p.add_argument("--seed", type=int, default=2)

    args = parser.parse_args(argv)
    args.job(spark or get_session(), args)


if __name__ == "__main__":
    main()
