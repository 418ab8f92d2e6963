"""Second opinions that came back as raw replies: check them, and settle on one per order."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.fixed_values import CAUSES, FAILED_TEMPLATE
from tieout.functions.text import fill, message_text


def normalize_confidence(c: Column | str) -> Column:
    """Percentages to fractions, then held within 0 and 1."""
    c = F.col(c) if isinstance(c, str) else c
    fraction = F.when(c > 1, c / 100).otherwise(c)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), fraction))
    return F.when(c.isNotNull(), clamped)


REPLY_FIELDS = ("cause", "explanation", "confidence", "recommended_action")


def _with_reply(responses: DataFrame) -> DataFrame:
    """Replies with ``_reply``: the whole text as one JSON value, or null.

    The parser stops at the end of the first value and ignores what follows. Inside a list
    and inside an object that is an error, so both must parse, with one element. Each step
    is a column of its own so that no text is parsed twice.
    """
    text = F.col("_text")
    single = F.col("_in_object").isNotNull() & (
        F.try_variant_get("_in_list", "$[1]", "variant").isNull()
    )
    return (
        responses.withColumn("_text", message_text(F.col("content")))
        .withColumns(
            {
                "_in_list": F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))),
                "_in_object": F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))),
            }
        )
        .withColumn("_reply", F.when(single, F.try_variant_get("_in_list", "$[0]", "variant")))
    )


def parse_diagnosis(responses: DataFrame) -> DataFrame:
    """Replies with their fields read out, ``valid`` and, where not valid, ``error``.

    All four fields must be there with the right JSON type and a known cause; further keys
    are ignored. A confidence that is not a number makes the reply invalid.
    """
    fields = _with_reply(responses).select(
        *responses.columns,
        F.col("_reply").isNotNull().alias("_is_json"),
        *[F.try_variant_get("_reply", f"$.{c}", "variant").alias(f"_{c}") for c in REPLY_FIELDS],
    )
    # the type as written, so that "5" is not taken for 5
    typed = fields.withColumns(
        {f"_{c}_type": F.schema_of_variant(F.col(f"_{c}")) for c in REPLY_FIELDS}
    )

    def read(c: str, kind: str) -> Column:
        return F.try_variant_get(f"_{c}", "$", kind)

    def text_field(c: str) -> Column:
        return F.when(F.col(f"_{c}_type") == "STRING", read(c, "string")).alias(c)

    kind = F.col("_confidence_type")
    number = kind.startswith("BIGINT") | kind.startswith("DECIMAL") | kind.startswith("DOUBLE")
    values = typed.select(
        *responses.columns,
        "_is_json",
        text_field("cause"),
        text_field("explanation"),
        F.when(number, read("confidence", "double")).alias("confidence"),
        text_field("recommended_action"),
    ).withColumn("confidence", normalize_confidence("confidence"))
    unknown = F.col("cause").isNull() | ~F.col("cause").isin(*CAUSES)
    error = F.coalesce(
        F.when(~F.col("_is_json"), F.lit("not JSON")),
        F.when(unknown, F.lit("invalid field: cause")),
        *[
            F.when(F.col(c).isNull(), F.lit(f"invalid field: {c}"))
            for c in ("explanation", "confidence", "recommended_action")
        ],
    )
    return values.withColumn("error", error).select(
        *responses.columns, F.col("error").isNull().alias("valid"), *REPLY_FIELDS, "error"
    )


def resolve_attempts(parsed: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """One row per order that has a reply: the first valid attempt, or the last error.

    Attempts are taken in the order of their numbers, whatever these are; rows that repeat a
    number are one attempt, and attempts without a number come last. ``attempts_used`` and
    ``latency_ms`` count the attempts made until the decision. ``max_attempts`` looks at the
    first so many only. Repeated rows are combined before they are sent, and a running count
    over an order's attempts streams, so many replies on one order do no harm.
    """
    number = F.coalesce("attempt", F.lit(2**63 - 1)).alias("_number")
    answer = F.min(F.when(F.col("valid"), F.struct(*REPLY_FIELDS))).alias("_answer")
    made = parsed.groupBy("order_id", number).agg(
        answer,
        F.max(F.when(~F.col("valid"), F.col("error"))).alias("_error"),
        F.max("latency_ms").alias("_ms"),
        F.min("model").alias("model"),
        F.min("prompt_version").alias("prompt_version"),
    )
    so_far = Window.partitionBy("order_id").orderBy("_number")
    until = so_far.rowsBetween(Window.unboundedPreceding, 0)
    made = made.withColumn("_nth", F.row_number().over(so_far).cast("bigint"))
    if max_attempts is not None:
        made = made.filter(F.col("_nth") <= max_attempts)
    made = made.withColumn("_spent", F.sum(F.coalesce("_ms", F.lit(0).cast("bigint"))).over(until))
    step = ("_nth", "_spent", "_answer", "_error")
    valid, failed = F.col("_answer").isNotNull(), F.col("_answer").isNull()
    grouped = made.groupBy("order_id").agg(
        F.min(F.when(valid, F.struct(*step))).alias("_first"),
        F.max(F.when(failed, F.struct(*step))).alias("_last"),
        F.min("model").alias("model"),
        F.min("prompt_version").alias("prompt_version"),
    )
    decided = F.coalesce("_first", "_last")
    message = fill(
        FAILED_TEMPLATE, attempts=decided["_nth"], error=decided["_error"]
    )
    found = F.col("_first").isNotNull()
    return grouped.select(
        "order_id",
        found.alias("diagnosed"),
        decided["_nth"].alias("attempts_used"),
        *[F.col(f"_first._answer.{c}").alias(c) for c in REPLY_FIELDS],
        F.when(~found, message).alias("error"),
        decided["_spent"].alias("latency_ms"),
        "model",
        "prompt_version",
    )


def diagnosis_outcome(selected: DataFrame, resolved: DataFrame) -> DataFrame:
    """How many selected orders were diagnosed, failed, or never reached."""
    outcome = (
        F.when(F.col("diagnosed"), F.lit("ok"))
        .when(F.col("diagnosed").isNotNull(), F.lit("failed"))
        .otherwise(F.lit("not_reached"))
    )
    joined = selected.join(resolved.select("order_id", "diagnosed"), "order_id", "left")
    return joined.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
