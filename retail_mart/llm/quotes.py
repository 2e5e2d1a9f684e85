"""Quotation linking: rebuild conversations from messages that quote each other (DataFrame functions only).

A line's quote level is the number of '>' before it. A message's own text is
its lines of level 0 without attribution lines; its quoted passages are the
lines of each deeper level. Lines and whole passages are normalised (lower
case, single blanks), hashed, and joined to the messages that wrote them: each
time a hash is quoted it stands for the latest earlier message of its scope
that wrote it, so a common line gives one partner, not all pairs. A whole
message is hashed together with the passage that it quotes itself, too, so the
deeper level tells repeated replies apart. A passage's source is the earlier
message that agrees in text and quote, else in its whole text, else the one
with most characters in common; the latest on ties.
A message replies to the source of its shallowest passage; root and depth
follow by pointer doubling, and conversations are its messages by root, depth
and order, without quotes.

Edge cases: a null or empty text is a message without passages; blank lines
are not matched; a passage that no earlier message of its scope wrote stays
unlinked, a message without linked passages starts a conversation; equal rows
are one message (the one with the smallest order); messages of equal order
don't reply to each other; null scopes are one scope; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm.common import cut

# Parts of the orders, which bound the rows of a common hash that are ordered together.
_BLOCKS = 4096
LINE, WHOLE, REPLY = 0, 1, 2
_LEVEL = r"^(?:\s*>)+"
_ATTRIBUTION = r"(?i)^\s*on\b.*\bwrote:\s*$"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text: Column) -> Column:
    """Per line: its level and its body."""
    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, _LEVEL, 0)
        level = F.length(F.regexp_replace(marks, r"[^>]", ""))
        body = F.when(level > 0, F.regexp_replace(F.regexp_replace(line, _LEVEL, ""), "^ ", "")).otherwise(line)
        return F.struct(level.alias("level"), body.alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n", -1), one)


def parse(messages: DataFrame, msg_id: str = "msg_id", scope: str = "scope", order: str = "ord", text: str = "text") -> DataFrame:
    """(msg_id, scope, ord, own, passages): own text, and per level from 1 the lines of that level."""
    m = messages.select(F.col(msg_id).cast("string").alias("msg_id"), F.col(scope).cast("string").alias("scope"),
                        F.col(order).cast("long").alias("ord"), _lines(F.col(text).cast("string")).alias("lines"))
    wrote = F.filter("lines", lambda x: (x["level"] == 0) & ~x["body"].rlike(_ATTRIBUTION))
    levels = F.array_sort(F.array_distinct(F.transform(F.filter("lines", lambda x: x["level"] > 0), lambda x: x["level"])))
    passage = lambda lv: F.struct(lv.alias("level"), F.transform(F.filter(
        "lines", lambda x: (x["level"] == lv) & ~x["body"].rlike(_ATTRIBUTION)), lambda x: x["body"]).alias("body"))
    m = m.select("msg_id", "scope", "ord", F.regexp_replace(F.array_join(F.transform(wrote, lambda x: x["body"]), "\n"), r"^\s+|\s+$", "").alias("own"),
                 F.transform(levels, passage).alias("passages"))
    return m.groupBy("msg_id").agg(F.min_by(F.struct("scope", "ord", "own", "passages"), F.struct(F.col("ord").isNull(), "ord", "own")).alias("m")).select("msg_id", "m.*")


def _latest(uses: DataFrame, width: float) -> DataFrame:
    """(s, h, kind, ord, source) of what was quoted: the latest earlier writer.

    uses: (s, h, kind, ord, writer), writer null where it is quoted. Only one
    row for each order of a hash is sorted, within a block of orders; blocks
    before are looked up through one row each.
    """
    of = ["s", "h", "kind"]
    u = uses.groupBy(*of, "ord").agg(F.min("writer").alias("writer"), F.max(F.col("writer").isNull()).alias("asked"))
    u = u.withColumn("block", F.floor(F.col("ord").cast("double") / width))
    wrote = F.when(F.col("writer").isNotNull(), F.struct(F.col("ord").alias("at"), F.col("writer").alias("msg_id")))
    u = cut(u.withColumn("source", F.max(wrote).over(Window.partitionBy(*of, "block").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))))
    before = u.groupBy(*of, "block").agg(F.max(wrote).alias("last"))
    before = before.withColumn("last", F.max("last").over(Window.partitionBy(*of).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    asked = u.filter("asked").join(before.filter("last is not null"), [*of, "block"], "left")
    return asked.select(*of, "ord", F.coalesce("source", "last").alias("source")).filter("source is not null")


def links(parsed: DataFrame) -> DataFrame:
    """(msg_id, level, source): the message that wrote each quoted passage."""
    key = lambda text: F.substring(F.sha2(text, 256), 1, 32)
    s = F.coalesce(F.concat(F.lit("s"), F.col("scope")), F.lit("n"))
    unit = lambda text, kind: F.struct(text.alias("t"), F.lit(kind).alias("kind"))
    passage = lambda p: normal(F.array_join(p["body"], " "))

    def reply(text: Column, quoted: Column) -> Column:
        return unit(F.when((text != "") & (quoted != ""), F.concat(text, F.lit("\n"), quoted)).otherwise(F.lit("")), REPLY)

    timed = parsed.filter("ord is not null")
    own, first = normal(F.col("own")), F.coalesce(passage(F.get("passages", F.lit(0))), F.lit(""))
    wrote = timed.select(s.alias("s"), "ord", "msg_id", F.explode(F.concat(
        F.transform(F.split("own", "\n"), lambda x: unit(normal(x), LINE)), F.array(unit(own, WHOLE), reply(own, first)))).alias("u"))
    wrote = wrote.filter(F.col("u.t") != "").select("s", key(F.col("u.t")).alias("h"), F.col("u.kind").alias("kind"), "ord", F.col("msg_id").alias("writer"))
    deeper = F.transform("passages", lambda p, i: F.struct(p["level"].alias("level"), p["body"].alias("body"), F.coalesce(
        passage(F.get("passages", i + 1)), F.lit("")).alias("next")))
    p = timed.select(s.alias("s"), "ord", "msg_id", F.explode(deeper).alias("p"))
    text = passage(F.col("p"))
    quoted = p.select("s", "ord", "msg_id", F.col("p.level").alias("level"), F.explode(F.concat(
        F.transform("p.body", lambda x: unit(normal(x), LINE)), F.array(unit(text, WHOLE), reply(text, F.col("p.next"))))).alias("u"))
    quoted = cut(quoted.filter(F.col("u.t") != "").select("s", "ord", "msg_id", "level", key(F.col("u.t")).alias("h"), F.col("u.kind").alias("kind"),
                                                          F.length("u.t").alias("n")))
    r = timed.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).first()
    width = max(1.0, (float(r.hi) - float(r.lo)) / _BLOCKS) if r.lo is not None else 1.0
    found = quoted.join(_latest(wrote.union(quoted.select("s", "h", "kind", "ord", F.lit(None).cast("string"))), width), ["s", "h", "kind", "ord"])
    votes = found.groupBy("msg_id", "level", F.col("source.msg_id").alias("source"), F.col("source.at").alias("at")).agg(
        F.max("kind").alias("kind"), F.sum("n").alias("n"))
    best = F.max_by("source", F.struct("kind", "n", "at", "source"))
    return votes.groupBy("msg_id", "level").agg(best.alias("source"))


def conversations(messages: DataFrame, msg_id: str = "msg_id", scope: str = "scope", order: str = "ord", text: str = "text") -> DataFrame:
    """Per message: msg_id, reply_to, root, depth, ord, text (without quotes); a conversation is its root's rows by depth and ord."""
    parsed = cut(parse(messages, msg_id, scope, order, text))
    parent = links(parsed).groupBy("msg_id").agg(F.min_by("source", "level").alias("reply_to"))
    tree = cut(parsed.select("msg_id").join(parent, "msg_id", "left").select(
        "msg_id", "reply_to", F.coalesce("reply_to", "msg_id").alias("up"), F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    # only messages that have not reached their root are joined again
    done, going = tree.filter("reply_to is null"), tree.filter("reply_to is not null")
    while True:
        far = done.union(going).select(F.col("msg_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        step = cut(going.join(far, "up").select("msg_id", "reply_to", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                                                (F.col("next") != F.col("up")).alias("moved")))
        done = done.union(step.filter(~F.col("moved")).drop("moved"))
        going = step.filter("moved").drop("moved")
        if not going.limit(1).count():
            break
    tree = done
    return tree.join(parsed.select("msg_id", "ord", "own"), "msg_id").select(
        "msg_id", "reply_to", F.col("up").alias("root"), "depth", "ord", F.col("own").alias("text"))
