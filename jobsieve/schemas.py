"""Declared schemas. Every reader uses these; nothing is inferred."""

from pyspark.sql import types as T

# Field names and their order, spelling included.
POST_FIELDS = [
    "Job_ID",
    "Title",
    "Company_name",
    "Location",
    "Pubblication_date",
    "Description",
    "Seniority_level",
    "Employment_type",
    "Job_Function",
    "Industry_type",
]
# The columns that are lower-cased.
LOWERED_FIELDS = [
    "Title",
    "Company_name",
    "Location",
    "Seniority_level",
    "Employment_type",
    "Job_Function",
    "Industry_type",
]
# Fields the HTTP transport adds to an event.
TRANSPORT_FIELDS = ["http", "url", "user_agent", "@version", "host", "event"]
# Leaves of the Skills struct.
CATEGORY_LEAVES = [
    "cloud_providers",
    "programming_languages",
    "frontend_frameworks",
    "backend_frameworks",
    "databases",
    "devops_tools",
    "monitoring_tools",
    "testing_frameworks",
]
SERVICE_LEAVES = ["aws", "gcp", "azure", "ibm", "oracle"]
# Labels, their ids, the ignored id and the special tokens.
LABEL_IDS = {"O": 0, "B-SKILL": 1, "I-SKILL": 2}
IGNORED_LABEL_ID = -100
SPECIAL_TOKENS = ["[CLS]", "[SEP]", "[PAD]"]
DATE_FORMAT = "yyyy-MM-dd"

STRINGS = T.ArrayType(T.StringType())


def _strings_struct(names):
    return T.StructType([T.StructField(n, STRINGS) for n in names])


POST = T.StructType([T.StructField(n, T.StringType()) for n in POST_FIELDS])

SKILLS = T.StructType(
    [
        T.StructField("raw_skills", STRINGS),
        T.StructField("categories", _strings_struct(CATEGORY_LEAVES)),
        T.StructField("cloud_services", _strings_struct(SERVICE_LEAVES)),
    ]
)

ENRICHED_POST = T.StructType(
    [f for f in POST.fields if f.name != "Description"] + [T.StructField("Skills", SKILLS)]
)

# The two keyed tables, with the publication date typed as a date.
DEDUPED_TABLE = T.StructType(
    [
        T.StructField(f.name, T.DateType()) if f.name == "Pubblication_date" else f
        for f in POST.fields
    ]
)
ENRICHED_TABLE = T.StructType(
    [
        T.StructField(f.name, T.DateType()) if f.name == "Pubblication_date" else f
        for f in ENRICHED_POST.fields
    ]
)

LABELLED_TOKENS = T.StructType(
    [
        T.StructField(
            "tokens",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("position", T.IntegerType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("label", T.StringType()),
                    ]
                )
            ),
        )
    ]
)
