"""Job posts, labelled tokens and web pages derived from the given tables.

Every derivation keeps whole tables and whole texts and works row by row, so it also runs on a
stream.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col, let
from ..schemas import POST_FIELDS
from ..sources.readers import spread

# Values the derived posts cycle through.
TITLES = [
    "Frontend Developer",
    "Sviluppatore Back-End",
    "Business Analyst",
    "iOS Programmer",
    "Plumber",
    "Machine Learning Engineer",
    "full-stack developer",
]
MENTIONS = [
    "ReactJS, Python3 and AWS",
    "Spring-Boot with Postgres on Oracle",
    "k8s Docker Amazon Web Services S3",
    "GCP BigQuery pubsub",
    "Azure Cosmos DB c# dotnet",
    "Azure SQL Server; C++ (or cpp) and .NET",
    "Node. js, TypeScript; Vue.js Jenkins.",
    "Oracle Cloud Infrastructure, Terraform, Go",
    "IBM DB2, DynamoDB, RDS, Aurora DB",
    "Java, Spring  Boot, JUnit, SQL. Git",
    "Google Kubernetes Engine and Cloud Run! R or Scala?",
]


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    """One of the given tables; those with long texts are spread over all cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages") else df


def pick(values, index):
    """The value a number selects by cycling through a list."""
    array = F.array(*[F.lit(v) for v in values])
    return F.element_at(array, (col(index) % len(values) + 1).cast("int"))


def posts_of(documents: DataFrame) -> DataFrame:
    """Two arrivals per document: a scrape without description, then the whole text.

    Three consecutive documents share a Job_ID, so keys repeat. Some first scrapes hold only
    white space, some dates are missing or malformed.
    """
    d = F.col("doc_id")
    blank = F.when(d % 7 == 0, " \t ").when(d % 2 == 0, "").otherwise(F.lit(None))
    full = F.concat(pick(MENTIONS, d), F.lit(". "), F.col("text"))
    date = (
        F.when(d % 17 == 0, F.lit(None))
        .when(d % 13 == 0, "15/03/2024")
        .when(d % 19 == 0, "2024-02-30")
        .otherwise(F.concat(F.lit("2024-0"), (1 + d % 9).cast("string"), F.lit("-15")))
    )
    return documents.select(
        "*", F.posexplode(F.array(blank, full)).alias("scrape", "Description")
    ).select(
        (d * 2 + F.col("scrape")).alias("arrival"),
        F.concat(F.lit("J"), (d - d % 3).cast("string")).alias("Job_ID"),
        pick(TITLES, d).alias("Title"),
        F.concat(F.lit("Company "), (d % 23).cast("string")).alias("Company_name"),
        F.upper("lang").alias("Location"),
        date.alias("Pubblication_date"),
        "Description",
        F.when(d % 4 == 0, "Entry level").otherwise("Mid-Senior level").alias("Seniority_level"),
        F.when(d % 5 == 0, "Contract").otherwise("Full-time").alias("Employment_type"),
        F.lit("Engineering").alias("Job_Function"),
        F.concat(F.lit("Industry "), "source").alias("Industry_type"),
    )


def posts(spark, sf_dir, task_bytes=None) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return posts_of(spread(documents, task_bytes=task_bytes) if task_bytes else documents)


def payloads(spark, sf_dir) -> DataFrame:
    """Posts as JSON bytes; by arrival some are malformed, wrapped, misspelt or oddly typed."""
    p = posts(spark, sf_dir).withColumn("_j", F.to_json(F.struct(*POST_FIELDS, F.lit(1).alias("extra"))))
    a = F.col("arrival") % 50
    value = (
        F.when(a == 7, "not json")
        .when(a == 11, "")
        .when(a == 13, F.concat(F.lit("["), "_j", F.lit("]")))
        .when(a == 17, F.replace("_j", F.lit('"Job_ID"'), F.lit('"job_id"')))
        .when(a == 19, F.regexp_replace("_j", '"Job_ID":"J([0-9]+)"', '"Job_ID":$1'))
        .when(a == 23, F.replace("_j", F.lit('"Job_Function":"Engineering"'), F.lit('"Job_Function":{"a":1}')))
        .otherwise(F.col("_j"))
    )
    return p.select("arrival", value.cast("binary").alias("value"))


def _label(pos):
    h = (F.col("doc_id") * 31 + pos * 17) % 5
    return F.when(h == 0, "B-SKILL").when(h.isin(1, 2), "I-SKILL").otherwise("O")


def _piece(t, pos):
    """Some tokens are ``##`` pieces and some are special tokens."""
    return F.when(pos % 11 == 5, "[SEP]").when(pos % 4 == 3, F.concat(F.lit("##"), t)).otherwise(t)


def _labelled(item):
    """``item(token, position, label)`` of every blank-separated token of a document, as an array.

    Labels follow from the remainder of doc_id * 31 + position * 17 by 5. From zero on it returns after five positions, so
    five labels a document are worked out and looked up; below zero each is worked out.
    """
    doc, words = F.col("doc_id"), F.split("text", " ")
    five = F.array(*[_label(F.lit(k)) for k in range(5)])
    looked_up = let(five, lambda labels: F.transform(words, lambda t, pos: item(t, pos, F.get(labels, pos % 5))))
    return F.when(doc >= 0, looked_up).otherwise(F.transform(words, lambda t, pos: item(t, pos, _label(pos))))


def bio_arrays(spark, sf_dir) -> DataFrame:
    """Every blank-separated token of every document with a computed label, as one array."""

    def tag(t, pos, label):
        return F.struct(_piece(t, pos).alias("token"), label.alias("label"))

    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), _labelled(tag).alias("tagged"))


def bio_rows(spark, sf_dir, task_bytes=None) -> DataFrame:
    """The same as rows (doc, pos, token, label), worked out row by row: compiled code, unlike that of arrays."""
    documents = table(spark, sf_dir, "documents")
    documents = spread(documents, task_bytes=task_bytes) if task_bytes else documents
    words = documents.select("doc_id", F.posexplode_outer(F.split("text", " ")).alias("pos", "t")).filter("t IS NOT NULL")
    pos = F.col("pos")
    return words.select(F.col("doc_id").alias("doc"), pos, _piece(F.col("t"), pos).alias("token"), _label(pos).alias("label"))


def labelled_docs(spark, sf_dir) -> DataFrame:
    """One labelled record per document: tokens as (position, text, label), in reverse order."""
    items = _labelled(lambda t, i, label: F.struct(i.alias("position"), t.alias("text"), label.alias("label")))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc"), F.reverse(items).alias("tokens")
    )


def alias_chains(spark, sf_dir) -> DataFrame:
    """An alias for most documents: chains of up to 96 steps, and every second one closed to a cycle."""
    d = F.col("doc_id")
    name = lambda i: F.concat(F.lit("name-"), i.cast("string"))
    to = F.when(d % 97 != 0, d - 1).when(d % 2 == 0, d + 96)
    rows = table(spark, sf_dir, "documents").select(name(d).alias("alias"), name(to).alias("canonical"))
    return rows.filter("canonical IS NOT NULL")


def listing_pages(spark, sf_dir) -> DataFrame:
    """One listing page per document, with two cards; the second card lacks some fields.

    Cards lie in a wrapper and hold a list of their own.
    """
    d = F.col("doc_id")

    def card(job, title, company, rest):
        return F.concat(
            F.lit('<li>\n <section><div class="base-card relative" data-entity-urn="urn:x:job:'),
            job.cast("string"),
            F.lit('"><a class="full-link" href="/v"><span class="sr-only"> '),
            title,
            F.lit(' </span></a><div class="info"><h4 class="sub"><a href="/c">'),
            company,
            F.lit("</a></h4>"),
            rest,
            F.lit("</div><ul><li>tag</li></ul></div></section></li>"),
        )

    place = F.concat(
        F.lit('<span class="job-search-card__location"> '),
        F.upper("lang"),
        F.lit(' </span><time class="date" datetime="2024-03-'),
        F.lpad((1 + d % 28).cast("string"), 2, "0"),
        F.lit('">new</time>'),
    )
    title = F.concat(pick(TITLES, d), F.lit(" &amp; Co"))
    company = F.concat(F.lit("Company "), F.col("source"))
    page = F.concat(
        F.lit("<html><body><ul>"),
        card(d * 2, title, company, place),
        card(d * 2 + 1, F.lit("Caf&eacute; &#233; &#x20AC;"), F.lit("  "), F.lit("<time>old</time>")),
        F.lit("</ul></body></html>"),
    )
    return table(spark, sf_dir, "documents").select(d.alias("page_id"), page.alias("html"))


def detail_pages(spark, sf_dir) -> DataFrame:
    """One detail page per card; the whole document is the description of the first card."""
    d = F.col("doc_id")
    text = F.col("text")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    full = F.concat(
        F.lit('<html><section><div class="show-more-less-html__markup x"><div><b>'),
        pick(MENTIONS, d),
        F.lit("</b></div><!-- cut --><p>"),
        text,
        F.lit('</p></div><div class="after">More</div></section><ul class="criteria">'),
        F.lit("<li><h3>Seniority</h3><span> Entry level </span></li><li><h3>Type</h3><span>"),
        F.when(d % 5 == 0, "Contract").otherwise("Full-time"),
        F.lit("</span></li><li><h3>Function</h3><span>  </span></li><li><h3>Industry</h3><span>"),
        F.col("source"),
        F.lit(" &lt;x&gt;</span></li></ul></html>"),
    )
    bare = F.lit("<html><ul><li>no span</li></ul></html>")
    return table(spark, sf_dir, "documents").select(
        F.posexplode(F.array(full, bare)).alias("n", "html"), d.alias("d")
    ).select((F.col("d") * 2 + F.col("n")).cast("string").alias("Job_ID"), "html")
