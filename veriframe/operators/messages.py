"""Many messages, held in a table, against many lines: an inverted index of rare character grams, then verification.

Each message is entered once, under the gram of its own that a share of the lines
holds least often (which gram it is changes the work, never the result). A piece of a line is compared only with messages that are entered
under one of its grams, so the work follows the lines and the true hits, not
the number of messages times the number of lines. Messages are plain text,
never patterns.

A message with a space is entered by grams around or after its spaces, the first
size that fits, others by grams that begin anywhere; texts list a kind of gram only
when some message needs it. A gram that reaches over a space tells more than the
short word behind it: few pieces are compared with a message in vain.

Equal lines are compared once, whatever number of rows they are. A text of any
length is cut into pieces that overlap by the longest message, so a row has a
bounded size and each hit lies whole in a piece. Grams are never shuffled: the
index goes out in blocks of bounded size, one pass over the pieces each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.operators.verdict import FAIL, PASS
from veriframe.sources.workspace import written

#: Characters before and after the space of a gram, the first that fits (without any before, the gram begins after the space).
AT_SPACE = ((2, 5), (2, 2), (0, 2), (0, 1))
#: Characters of grams anywhere, at most.
ANYWHERE = 4
#: Grams of a message among which the rarest is looked for.
TRIED = 16
#: Grams are counted in one of so many texts, by hash.
SHARE = 16
#: Characters of a text that are handled at a time (the longest message, if that is longer).
PIECE = 4_096
#: Bytes of the index that are sent to every task at once.
BLOCK_BYTES = 32_000_000


def _pattern(kind: str) -> str:
    """Grams of a kind: ``s2.5`` are a space with 2 characters before and 5 after, ``s0.2`` the 2 after a space, ``a4`` any 4."""
    if kind[0] == "a":
        return f"(?s)(?=(.{{{kind[1:]}}}))"
    before, after = kind[1:].split(".")
    # looked for from the space on, which most positions are not
    return f"(?s) (?=(.{{{after}}}))" if before == "0" else f"(?s) (?<=(?=(.{{{before}}} .{{{after}}})).{{{before}}} )"


def _length(kind: str) -> int:
    """Characters of the grams of a kind."""
    if kind[0] == "a":
        return int(kind[1:])
    before, after = map(int, kind[1:].split("."))
    return before + 1 + after if before else after


def _kind(message: str) -> Column:
    """The kind of grams by which a message is entered: at a space with only characters of one code unit around, which patterns count one by one."""
    plain = r"[^\x{10000}-\x{10FFFF}]"
    anywhere = F.concat(F.lit("a"), F.least(F.char_length(message), F.lit(ANYWHERE)).cast("string"))
    spaced = reduce(
        lambda rest, size: F.when(F.col(message).rlike(f"{plain}{{{size[0]}}} {plain}{{{size[1]}}}"), F.lit(f"s{size[0]}.{size[1]}")).otherwise(rest),
        reversed(AT_SPACE), anywhere)
    return F.when(F.col(message) == "", F.lit("")).otherwise(spaced)


def _grams(text: str, kinds: list[str]) -> Column:
    return F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(_pattern(k)), F.lit(1)) for k in kinds]))


def _pieces(texts: DataFrame, longest: int, *keep: str) -> DataFrame:
    """The texts in pieces, each with what follows it as far as a message may reach."""
    size = max(PIECE, longest)
    cut = F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{1,{size + longest}}})).{{1,{size}}}"), F.lit(1))
    return texts.select(*keep, F.explode(cut).alias("piece"))


def _dealt(entries: DataFrame) -> list[DataFrame]:
    """The entries in blocks of about ``BLOCK_BYTES``, each for a broadcast."""
    names = entries.columns
    width = reduce(lambda a, b: a + b, [F.octet_length(c) for c in names], F.lit(64))
    total = entries.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    return [F.broadcast(entries.where(F.pmod(F.xxhash64(*names), F.lit(blocks)) == k)) for k in range(blocks)]


def message_index(pieces: DataFrame, messages: DataFrame) -> DataFrame:
    """``gram, message``: each message under the gram of its own that the pieces hold least often."""
    kinds = _kinds(messages)
    lists, length = F.array().cast("array<string>"), F.lit(0)
    for kind in kinds:
        lists = F.when(F.col("kind") == kind, _grams("message", [kind])).otherwise(lists)
        length = F.when(F.col("kind") == kind, _length(kind)).otherwise(length)
    # a gram may begin inside a character of two code units; such a one is no part of the message's text
    inside = F.filter(lists, lambda g: (F.char_length(g) == length) & F.contains("message", g))
    hashed = F.slice(F.sort_array(F.transform(inside, lambda g: F.struct(F.xxhash64(g).alias("hash"), g.alias("gram")))), 1, TRIED)
    own = written(messages.select("message", F.explode(hashed).alias("tried")).select("tried.gram", "message"), "grams")
    listed = pieces.select(F.explode(_grams("piece", kinds)).alias("gram"))
    counts = reduce(DataFrame.unionByName, [
        listed.join(block, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("held"))
        for block in _dealt(own.select("gram").distinct())])
    entered = own.join(counts, "gram", "left").groupBy("message").agg(
        F.min(F.struct(F.coalesce("held", F.lit(0).cast("bigint")).alias("held"), F.xxhash64("gram").alias("hash"), "gram")).alias("rarest"))
    return entered.select(F.col("rarest.gram").alias("gram"), "message")


def _kinds(messages: DataFrame) -> list[str]:
    """The kinds of grams among the messages, of which there are a dozen at most."""
    return sorted(r[0] for r in messages.select("kind").distinct().collect())


def _messages(messages: DataFrame, column: str) -> DataFrame:
    return messages.select(F.col(column).cast("string").alias("message")).where("message is not null").distinct()


def _distinct_texts(lines: DataFrame, column: str) -> DataFrame:
    """``key, text, rows`` of the distinct texts that are not null; a hot line leaves each task as one row."""
    texts = lines.select(F.col(column).cast("string").alias("text")).where("text is not null")
    return written(texts.groupBy("text").agg(F.count("*").alias("rows")).select(_key("text").alias("key"), "text", "rows"), "texts")


def _key(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("string").cast("binary")))


def _held(texts: DataFrame, messages: DataFrame) -> DataFrame:
    """``key, message, rows``: the distinct texts and the messages each of them holds, once a pair."""
    marked = messages.withColumn("kind", _kind("message"))
    found = marked.agg(F.collect_set("kind").alias("kinds"), F.max(F.char_length("message")).alias("longest")).first()
    everywhere = texts.select("key", F.lit("").alias("message"), "rows").where(F.lit("" in found.kinds))
    kinds = sorted(k for k in found.kinds if k)
    if not kinds:
        return everywhere
    pieces = _pieces(texts, found.longest, "key", "rows")
    share = _pieces(texts.where(F.pmod(F.xxhash64("key"), F.lit(SHARE)) == 0), found.longest)
    index = written(message_index(share, marked.where("kind <> ''")), "index")
    listed = pieces.select("key", "rows", "piece", F.explode(_grams("piece", kinds)).alias("gram"))
    met = [listed.join(block, "gram").where(F.contains("piece", "message")).select("key", "message", "rows") for block in _dealt(index)]
    return reduce(DataFrame.unionByName, met).groupBy("key", "message").agg(F.max("rows").alias("rows")).unionByName(everywhere)


def message_hits_from(lines: DataFrame, column: str, messages: DataFrame, message_column: str = "message") -> DataFrame:
    """``message, hits, status``: the lines that hold each message of a table, and one verdict: any hit passes for all.

    One row per distinct message; a message without a hit has 0, the empty
    message is in every line, null messages and null lines take no part. A
    table without messages gives no row.
    """
    wanted = _messages(messages, message_column)
    held = _held(_distinct_texts(lines, column), wanted)
    counted = held.groupBy("message").agg(F.sum("rows").alias("found"))
    hits = written(wanted.join(counted, "message", "left").select("message", F.coalesce("found", F.lit(0).cast("bigint")).alias("hits")), "hits")
    some = hits.agg(F.max("hits").alias("most")).scalar()
    return hits.select("message", "hits", F.when(some > 0, PASS).otherwise(FAIL).alias("status"))


def lines_with_messages(
    lines: DataFrame, column: str, messages: DataFrame, message_column: str = "message", count_column: str = "messages"
) -> DataFrame:
    """The rows whose text holds at least one message of a table, each with the number of distinct messages it holds."""
    key = "_key"
    while key in lines.columns:
        key += "_"
    held = _held(_distinct_texts(lines, column), _messages(messages, message_column))
    counted = held.groupBy("key").agg(F.count("*").alias(count_column)).withColumnRenamed("key", key)
    return lines.withColumn(key, _key(column)).join(counted, key).drop(key)
