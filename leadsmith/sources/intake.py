"""Lead intake: schemas, readers, defaults, validation (S1-S3) and agent-result
ingestion (S15).  All readers take an explicit schema — no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import blank, compact

# Allowed values of the lead model (fixed values of the reference data model).
SOURCE_CHANNELS = ["web_form", "linkedin", "twitter", "facebook", "instagram", "email_campaign",
                   "paid_search", "organic_search", "referral", "event"]
FORM_TYPES = ["demo_request", "contact_us", "whitepaper_download", "newsletter_signup",
              "webinar_registration", "free_trial"]

S = T.StringType()
LEAD_FIELDS = [
    "source_channel", "source_campaign", "source_url", "utm_source", "utm_medium", "utm_campaign",
    "form_type", "first_name", "last_name", "email", "phone", "linkedin_url", "company", "job_title",
    "department", "company_size", "industry", "country", "state_region", "message",
]
LEAD_SCHEMA = T.StructType(
    [T.StructField(f, S) for f in LEAD_FIELDS]
    + [T.StructField("interests", T.ArrayType(S)), T.StructField("opt_in_marketing", T.BooleanType()),
       T.StructField("page_load_time", S)]
)

MQL_RESULT_SCHEMA = T.StructType([
    T.StructField("lead_id", S), T.StructField("mql_id", S), T.StructField("qualified", T.BooleanType()),
    T.StructField("mql_score", T.IntegerType()),
    T.StructField("score_breakdown", T.MapType(S, T.IntegerType())),
    T.StructField("persona", S), T.StructField("buying_stage", S), T.StructField("nurture_track", S),
    T.StructField("agent_reasoning", S), T.StructField("confidence_score", T.DoubleType()),
])
MQL_FALLBACK = {"qualified": False, "mql_score": 0, "persona": "unknown", "buying_stage": "awareness",
                "reasoning": "Agent did not return structured output", "confidence": 0.5}


def read_leads(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = LEAD_SCHEMA,
               stream: bool = False) -> DataFrame:
    """Lead submissions from JSON / CSV / Parquet files (batch or stream) with a fixed
    schema; rows without an email are refused."""
    reader = spark.readStream if stream else spark.read
    if fmt == "csv" and not stream:
        # CSV columns are matched by header name (all text, no inference), then cast;
        # fields the file lacks (and arrays, which CSV cannot hold) become nulls
        raw = reader.option("header", "true").csv(path)
        df = raw.select(*[
            (F.col(f.name).cast(f.dataType) if f.name in raw.columns and not isinstance(f.dataType, T.ArrayType)
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    else:
        r = reader.schema(schema).format(fmt)
        if fmt == "csv":  # a CSV stream needs the schema's column order in the files
            r = r.option("header", "true")
        df = r.load(path)
    return df.filter(~blank("email"))


def parse_payloads(payloads: DataFrame, col: str = "payload", schema: T.StructType = LEAD_SCHEMA,
                   keep: list[str] | None = None) -> DataFrame:
    """S1 for JSON bodies already in a column: ``from_json`` with the fixed schema
    (PERMISSIVE: malformed bodies give nulls and are refused by the email check)."""
    keep = keep or []
    parsed = payloads.select(*keep, F.from_json(F.col(col), schema).alias("_p"))
    return parsed.select(*keep, "_p.*").filter(~blank("email"))


def apply_defaults(df: DataFrame, form_path: bool = True) -> DataFrame:
    """Channel web_form, form contact_us, interests [], opt-in true; country US on the form path."""
    defaults: dict[str, Column] = {
        "source_channel": F.lit("web_form"), "form_type": F.lit("contact_us"),
        "interests": F.array().cast("array<string>"), "opt_in_marketing": F.lit(True),
    }
    if form_path:
        defaults["country"] = F.lit("US")
    return df.select(*[F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def validation_errors(df: DataFrame) -> Column:
    """Error codes of a lead row (empty when valid)."""
    return compact([
        F.when(blank("email"), F.lit("email_required")),
        F.when(~F.col("source_channel").isin(*SOURCE_CHANNELS), F.lit("invalid_source_channel")),
        F.when(~F.col("form_type").isin(*FORM_TYPES), F.lit("invalid_form_type")),
    ])


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: (valid rows, invalid rows with an ``errors`` array) — one projection, two filters."""
    tagged = df.withColumn("errors", validation_errors(df))
    return (tagged.filter(F.size("errors") == 0).drop("errors"), tagged.filter(F.size("errors") > 0))


def _answers(answers: DataFrame, schema: T.StructType, col: str, key: str) -> tuple[DataFrame, Column]:
    """Rows with the answer as a struct ``r``, and whether it is there and well-formed."""
    whole = T.StructType(schema.fields + [T.StructField("_corrupt", S)])
    p = F.from_json(F.col(col), whole, {"columnNameOfCorruptRecord": "_corrupt"})
    r = answers.select(key, p.alias("r"), F.col(col).isNull().alias("_missing"))
    return r, F.col("r").isNotNull() & ~F.col("_missing") & F.col("r._corrupt").isNull()


def _outside(c: Column, low: float, high: float) -> Column:
    return c.isNull() | ~c.between(low, high)


TRIAGE_DECISIONS = ["accepted", "rejected", "needs_review"]
TRIAGE_FALLBACK = {"decision": "needs_review", "next_agent": "human_review",
                   "reasoning": "Agent did not return structured decision", "rejection_reason": None, "confidence": 0.5}
TRIAGE_RESULT_SCHEMA = T.StructType(
    [T.StructField(f, S) for f in ("decision", "next_agent", "reasoning", "rejection_reason")]
    + [T.StructField("confidence", T.DoubleType())])


def parse_triage_results(answers: DataFrame, col: str = "answer", key: str = "lead_id") -> DataFrame:
    """S15, triage stage: missing or unparsable answers take the fallback row (human review); an
    unknown decision, missing reasoning or a confidence outside 0..1 marks the row invalid."""
    r, parsed = _answers(answers, TRIAGE_RESULT_SCHEMA, col, key)
    errors = compact([
        F.when(parsed & ~F.coalesce(F.col("r.decision").isin(*TRIAGE_DECISIONS), F.lit(False)), F.lit("decision_invalid")),
        F.when(parsed & F.col("r.reasoning").isNull(), F.lit("reasoning_required")),
        F.when(parsed & _outside(F.col("r.confidence"), 0.0, 1.0), F.lit("confidence_out_of_range"))])
    fields = [F.when(parsed, F.col(f"r.{f}")).otherwise(F.lit(v)).alias(f) for f, v in TRIAGE_FALLBACK.items()]
    return r.select(key, *fields, (~parsed).alias("used_fallback"), (F.size(errors) == 0).alias("valid"), errors.alias("errors"))


BANT_BOUNDS = {"sql_score": 100, "bant_score_budget": 25, "bant_score_authority": 25, "bant_score_need": 25,
               "bant_score_timeline": 25}
BANT_RESULT_SCHEMA = T.StructType(
    [T.StructField("qualified", T.BooleanType())] + [T.StructField(f, T.IntegerType()) for f in BANT_BOUNDS]
    + [T.StructField("agent_reasoning", S), T.StructField("confidence_score", T.DoubleType())])


def parse_bant_results(answers: DataFrame, col: str = "answer", key: str = "lead_id") -> DataFrame:
    """S15, BANT stage: missing or unparsable answers take the fallback row (not qualified, all
    scores 0, confidence 0); a score or confidence out of bounds or a missing ``qualified`` marks
    the row invalid."""
    r, parsed = _answers(answers, BANT_RESULT_SCHEMA, col, key)
    conf = F.col("r.confidence_score")
    errors = compact([
        F.when(parsed & F.col("r.qualified").isNull(), F.lit("qualified_required")),
        *[F.when(parsed & _outside(F.col(f"r.{f}"), 0, top), F.lit(f"{f}_out_of_range")) for f, top in BANT_BOUNDS.items()],
        F.when(parsed & conf.isNotNull() & ~conf.between(0.0, 1.0), F.lit("confidence_out_of_range"))])
    return r.select(
        key, F.when(parsed, F.col("r.qualified")).otherwise(F.lit(False)).alias("qualified"),
        *[F.when(parsed, F.col(f"r.{f}")).otherwise(F.lit(0)).alias(f) for f in BANT_BOUNDS],
        F.when(parsed, F.col("r.agent_reasoning")).otherwise(F.lit("Agent processing error")).alias("agent_reasoning"),
        F.when(parsed, F.coalesce(conf, F.lit(0.8))).otherwise(F.lit(0.0)).alias("confidence_score"),
        (~parsed).alias("used_fallback"), (F.size(errors) == 0).alias("valid"), errors.alias("errors"))


def parse_mql_results(answers: DataFrame, col: str = "answer", key: str = "lead_id") -> DataFrame:
    """Agent JSON answers -> typed MQL results with checks.

    Missing or unparsable answers take the stage's fallback row; a score outside
    0..100, a confidence outside 0..1 or a missing ``qualified`` marks the row
    invalid (quarantine) with the reasons listed.
    """
    schema = T.StructType(MQL_RESULT_SCHEMA.fields + [T.StructField("_corrupt", S)])
    p = F.from_json(F.col(col), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    r = answers.select(key, p.alias("r"), F.col(col).isNull().alias("_missing"))
    parsed = F.col("r").isNotNull() & ~F.col("_missing") & F.col("r._corrupt").isNull()
    score = F.col("r.mql_score")
    conf = F.col("r.confidence_score")
    errors = compact([
        F.when(parsed & F.col("r.qualified").isNull(), F.lit("qualified_required")),
        F.when(parsed & (score.isNull() | ~score.between(0, 100)), F.lit("mql_score_out_of_range")),
        F.when(parsed & conf.isNotNull() & ~conf.between(0.0, 1.0), F.lit("confidence_out_of_range")),
    ])
    fb = MQL_FALLBACK
    return r.select(
        key,
        F.when(parsed, F.col("r.qualified")).otherwise(F.lit(fb["qualified"])).alias("qualified"),
        F.when(parsed, score).otherwise(F.lit(fb["mql_score"])).alias("mql_score"),
        F.when(parsed, F.col("r.persona")).otherwise(F.lit(fb["persona"])).alias("persona"),
        F.when(parsed, F.col("r.buying_stage")).otherwise(F.lit(fb["buying_stage"])).alias("buying_stage"),
        F.when(parsed, F.coalesce(conf, F.lit(0.8))).otherwise(F.lit(fb["confidence"])).alias("confidence_score"),
        (~parsed).alias("used_fallback"),
        (F.size(errors) == 0).alias("valid"),
        errors.alias("errors"),
    )


FORM_INTENTS, FORM_LEVELS, FORM_ADVICE = ["high", "medium", "low", "unclear"], ["low", "medium", "high", "critical"], ["accept", "reject", "review"]
FORM_NAMES = ["first_name", "last_name", "company", "job_title", "industry"]
FORM_RESULT_SCHEMA = T.StructType(
    [T.StructField(f"normalized_{f}", S) for f in FORM_NAMES] + [T.StructField("detected_intent", S), T.StructField("intent_signals", T.ArrayType(S)),
     T.StructField("bot_risk_score", T.IntegerType()), T.StructField("bot_risk_level", S), T.StructField("bot_risk_reasons", T.ArrayType(S)),
     T.StructField("lead_quality_score", T.IntegerType()), T.StructField("red_flags", T.ArrayType(S)), T.StructField("enrichment_notes", S),
     T.StructField("recommendation", S)])
#: Fields an answer of the form stage must give (the normalised industry and the notes may be missing).
FORM_REQUIRED = [f.name for f in FORM_RESULT_SCHEMA if f.name not in ("normalized_industry", "enrichment_notes")]


def parse_form_results(answers: DataFrame, col: str = "answer", key: str = "lead_id", cfg: dict | None = None) -> DataFrame:
    """S15, form stage: ``answers`` holds the lead's own fields and the rule screening's ``bot_score`` and ``flags`` beside the answer.

    A missing or unparsable answer takes the fallback: the lead's own values, the rule score with its level, the rule
    flags as reasons, quality 50, intent unclear, review.  A missing field, an unknown value or a score outside
    0..100 marks the row invalid."""
    from ..operators.screening import risk_level

    whole = T.StructType(FORM_RESULT_SCHEMA.fields + [T.StructField("_corrupt", S)])
    r = answers.withColumn("r", F.from_json(F.col(col), whole, {"columnNameOfCorruptRecord": "_corrupt"}))
    parsed = F.col("r").isNotNull() & F.col(col).isNotNull() & F.col("r._corrupt").isNull()
    a = lambda f: F.col(f"r.{f}")
    none, flags = F.array().cast("array<string>"), F.coalesce("flags", F.array().cast("array<string>"))
    fallback = {f"normalized_{f}": F.coalesce(f, F.lit("")) for f in FORM_NAMES} | {
        "detected_intent": F.lit("unclear"), "intent_signals": none, "bot_risk_score": F.col("bot_score").cast("int"),
        "bot_risk_level": risk_level(F.col("bot_score"), cfg), "bot_risk_reasons": flags, "lead_quality_score": F.lit(50), "red_flags": flags,
        "enrichment_notes": F.lit(None).cast("string"), "recommendation": F.lit("review")}
    errors = compact([
        *[F.when(parsed & a(f).isNull(), F.lit(f"{f}_required")) for f in FORM_REQUIRED],
        *[F.when(parsed & ~a(f).isin(*known), F.lit(f"{f}_invalid")) for f, known in
          (("detected_intent", FORM_INTENTS), ("bot_risk_level", FORM_LEVELS), ("recommendation", FORM_ADVICE))],
        *[F.when(parsed & ~a(f).between(0, 100), F.lit(f"{f}_out_of_range")) for f in ("bot_risk_score", "lead_quality_score")]])
    return r.select(key, *[F.when(parsed, a(f)).otherwise(v).alias(f) for f, v in fallback.items()],
                    (~parsed).alias("used_fallback"), (F.size(errors) == 0).alias("valid"), errors.alias("errors"))
