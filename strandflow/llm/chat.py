"""Chat formatting with typed content parts, in SQL functions only.

A message is a list of parts of type text, image, audio or document. A visitor
turns each part into output text: text is escaped, any other part becomes its
type's placeholder, and its reference and the tokens the placeholder stands for
are recorded in order. Control strings all begin with `<|`; inside texts a
backslash is doubled and `<|` becomes `<\\|`, so no text can hold one and the
output can be read back without loss.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MEDIA = ["image", "audio", "document"]

#: Parts of a message; only the fields of the part's type are looked at.
PART = "struct<type:string,text:string,source:string,width:int,height:int,seconds:double,pages:int>"

#: Tokens that stand for a part of unknown size, and the units of known ones.
IMAGE_TOKENS, IMAGE_PATCH = 576, 28
AUDIO_TOKENS, AUDIO_PER_SECOND = 750, 25
DOCUMENT_TOKENS, DOCUMENT_PER_PAGE = 1024, 1024

#: Media references inside plain text, and the file endings of each type (fixed values).
MARK = r"!\[[^\]\[]*\]\([^()\s]+\)"
ENDINGS = {"image": "png|jpe?g|gif|webp|bmp", "audio": "mp3|wav|ogg|flac|m4a", "document": "pdf|docx?|odt|pptx?|xlsx?"}


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expanded_tokens(part: Column) -> Column:
    """Tokens the placeholder of a part is replaced with when a batch is made; 0 for text."""
    patches = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
    return (
        F.when(part["type"] == "image", F.coalesce(patches, F.lit(IMAGE_TOKENS)))
        .when(part["type"] == "audio", F.coalesce(F.ceil(part["seconds"] * AUDIO_PER_SECOND), F.lit(AUDIO_TOKENS)))
        .when(part["type"] == "document", F.coalesce(part["pages"] * DOCUMENT_PER_PAGE, F.lit(DOCUMENT_TOKENS)))
        .otherwise(0)
        .cast("bigint")
    )


def visited(part: Column) -> Column:
    """Output text of one part. Unknown types count as text."""
    return F.when(part["type"].isin(MEDIA), F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(
        escaped(F.coalesce(part["text"], F.lit("")))
    )


def typed_parts(text: Column) -> Column:
    """Parts of a plain text: its media references by file ending, and the text between them."""
    kind = lambda m: F.coalesce(
        *[F.when(m.rlike(rf"(?i)\.({e})\)$"), F.lit(k)) for k, e in ENDINGS.items()], F.lit("text")
    )
    part = lambda k, t, s: F.struct(
        k.alias("type"), t.alias("text"), s.alias("source"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    none = F.lit(None).cast("string")
    plain = F.transform(F.split(text, MARK), lambda t: part(F.lit("text"), t, none))
    marks = F.transform(F.regexp_extract_all(text, F.lit(MARK), F.lit(0)), lambda m: part(kind(m), m, m))
    return F.filter(
        F.flatten(F.zip_with(plain, marks, lambda p, m: F.array(p, m))),
        lambda p: p.isNotNull() & (F.coalesce(p["text"], F.lit("")) != ""),
    )


def formatted(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss, attachments, expanded_tokens of every conversation.

    messages: conv_id, turn, role, parts (array of PART); other columns are not
    looked at. Turns stand by turn number, ties by role, then content; repeated
    rows are repeated turns. `loss` lists [start, end) in code points and the
    turn of the assistant's content; `attachments` lists turn (position from 1), type and
    source in order. A null role or part list counts as empty; rows without
    conv_id form one conversation without an id; an empty table gives an empty
    result. A conversation is one row of output by its nature; nothing else is
    gathered by key.
    """
    parts = F.coalesce(F.col("parts"), F.expr(f"CAST(array() AS array<{PART}>)"))
    media = F.filter("parts", lambda p: p["type"].isin(MEDIA))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts")).select(
        "conv_id", "turn", "role",
        F.array_join(F.transform("parts", visited), "").alias("body"),
        F.transform(media, lambda p: F.struct(p["type"].alias("type"), p["source"].alias("source"))).alias("media"),
        F.aggregate(
            F.transform(media, expanded_tokens), F.lit(0).cast("bigint"), lambda a, n: a + n
        ).alias("tokens"),
    )
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "media")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("head", head)
        .withColumn("chars", F.length("head") + F.length("body") + len(END))
        .withColumn("at", F.coalesce(F.sum("chars").over(before), F.lit(0)) + F.length("head"))
        .withColumn("k", F.row_number().over(order))
    )
    turn = F.struct(
        "k", F.concat("head", "body", F.lit(END)).alias("out"), "role", "media",
        F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end"), F.col("k").alias("turn")).alias(
            "span"
        ),
    )
    grouped = placed.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("turns"),
        F.sum("tokens").alias("expanded_tokens"),
    )
    return grouped.select(
        "conv_id", "n_turns",
        F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["span"]).alias("loss"),
        F.flatten(F.transform(
            "turns",
            lambda t: F.transform(
                t["media"], lambda m: F.struct(t["k"].alias("turn"), m["type"].alias("type"), m["source"].alias("source"))
            ),
        )).alias("attachments"),
        "expanded_tokens",
    )


def _restored(body: Column, sources: Column) -> Column:
    """The text of formatted content: unescaped, with the sources back in the placeholders' places."""
    between = F.split(body, r"<\|(?:" + "|".join(MEDIA) + r")\|>")
    return F.array_join(
        F.zip_with(between, sources, lambda t, s: F.concat(unescaped(t), F.coalesce(s, F.lit("")))), ""
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """The output of `formatted` with turns (role, text) and trained (texts under the loss mask) read from it."""
    pieces = F.split("formatted", r"<\|end\|>")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    of_turn = lambda k: F.transform(
        F.filter("attachments", lambda a: a["turn"] == k), lambda a: a["source"]
    )
    cut = conversations.withColumn("turns", F.transform(turns, lambda t: F.split(t, r"<\|text\|>")))
    told = F.transform(
        "turns",
        lambda t, i: F.struct(
            unescaped(F.substring(t[0], len(TURN) + 1, 2**31 - 1)).alias("role"),
            _restored(t[1], of_turn(i + 1)).alias("text"),
        ),
    )
    trained = F.transform(
        "loss",
        lambda span: _restored(
            F.substring("formatted", span["start"].cast("int") + 1, (span["end"] - span["start"]).cast("int")),
            of_turn(span["turn"]),
        ),
    )
    return cut.withColumns({"turns": told, "trained": trained})
