"""Near-duplicate lines by their deletion neighbourhood; every step is a DataFrame expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.llm.shared import numbered, stored

#: A line of fewer words has only exact duplicates: one edit among five words is a similarity of 0.8.
LEAST_WORDS = 5
#: Fixed value: what separates words, ASCII white space without the line feed that ends a line.
SPACE = "[ \\t\\r\\f\\x0B]+"

# A place is one whole decimal: the document's number, 30 bits of its text's hash
# (so that rows with one id and other texts are told apart), 31 bits of line number.
_LINE = "2147483648BD"
_TEXT = "1073741824BD"


def _words(line: Column) -> Column:
    return F.filter(F.split(line, SPACE), lambda w: w != "")


def _document(doc_id: str, text: str) -> Column:
    """The number that a document's places begin with; without an id it is beyond all ids and tells the texts apart."""
    hashed = f"xxhash64({text})"
    number = f"coalesce(cast({doc_id} as decimal(38,0)), cast(9223372036854775808BD + ({hashed} & 4611686018427387903) as decimal(38,0)))"
    return F.expr(f"cast(cast({number} * {_TEXT} as decimal(38,0)) + ({hashed} & 1073741823) as decimal(38,0))")


def _line_no(place: str) -> str:
    return f"cast(pmod({place}, {_LINE}) as int)"


def _doc_of(place: str) -> str:
    return f"cast(({place} - pmod({place}, {_LINE})) / {_LINE} as decimal(38,0))"


def lines(docs: DataFrame) -> DataFrame:
    """``place, words`` of the lines that have a word, of ``doc, text``."""
    return (
        docs.select("doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .where(F.col("line").rlike(f"[^{SPACE[1:-2]}]"))
        .select(F.expr(f"cast(cast(doc * {_LINE} as decimal(38,0)) + line_no as decimal(38,0))").alias("place"), _words(F.col("line")).alias("words")))


def _halves() -> list[Column]:
    """Hashes of the first and the last words, for partners as long and for partners a word longer or shorter.

    Two lines of m and m or m + 1 words within one edit agree in their first m / 2
    words or in their last m - m / 2.
    """
    out = []
    for m, use in (("size(words)", f"size(words) >= {LEAST_WORDS}"), ("(size(words) - 1)", f"size(words) > {LEAST_WORDS}")):
        half = f"cast(floor({m} / 2) as int)"
        for side, part in (("first", f"slice(words, 1, {half})"), ("last", f"slice(words, -({m} - {half}), {m} - {half})")):
            out.append(F.expr(f"if({use}, xxhash64('{side}', {m}, {part}), null)"))
    return out


def _unique(found: DataFrame) -> DataFrame:
    """One row per distinct line: the hashes that name it, its first place, the keys of its halves."""
    keys = ["first_same", "last_same", "first_less", "last_less"]
    hashed = found.select(
        F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"), "place", *[k.alias(name) for k, name in zip(_halves(), keys)])
    return hashed.groupBy("h1", "h2").agg(F.min("place").alias("place"), *[F.min(k).alias(k) for k in keys])


def _with_partner(unique: DataFrame) -> DataFrame:
    """Places of the lines that share a half with another line, so that a duplicate is possible."""
    keys = unique.select(
        "h1", "place", F.explode(F.array("first_same", "last_same", "first_less", "last_less")).alias("half")).where("half is not null")
    shared = keys.groupBy("half").agg(F.min("h1").alias("least"), F.max("h1").alias("most")).where("least <> most").select("half")
    return keys.join(shared, "half", "left_semi").select("place").distinct()


def _candidates(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``place, words`` of the lines at these places; a document's places are no more than its lines."""
    wanted = places.select(F.expr(_doc_of("place")).alias("doc"), "place").groupBy("doc").agg(F.collect_list("place").alias("places"))
    of_docs = docs.join(wanted, "doc").select("places", F.split("text", "\n").alias("lines"))
    return of_docs.select("lines", F.explode("places").alias("place")).select(
        "place", _words(F.expr(f"get(lines, {_line_no('place')})")).alias("words"))


def variants(found: DataFrame) -> DataFrame:
    """``place, key, gap``: a hashed key for every line and for the line without each of its words; ``gap`` is that word's number, 0 for the whole line.

    A word and its number are hashed together, and a line's key is the exclusive or
    over its words. Without word i the words behind it move up by one, so running
    sums from the left, under both numbers, give all keys of a line in one pass.
    """
    words = found.repartition("place").select("place", F.size("words").alias("n"), F.posexplode("words").alias("at", "word")).select(
        "place", "n", (F.col("at") + 1).alias("gap"), F.xxhash64("word", F.col("at") + 1).alias("here"), F.xxhash64("word", "at").alias("moved"))
    upto = "over (partition by place order by gap rows between unbounded preceding and current row)"
    whole = "over (partition by place)"
    sums = words.select(
        "place", "n", "gap",
        F.expr(f"bit_xor(here) {upto} ^ here").alias("before"),
        F.expr(f"bit_xor(moved) {whole} ^ bit_xor(moved) {upto}").alias("after"),
        F.expr(f"bit_xor(here) {whole}").alias("all"))
    without = "named_struct('key', xxhash64(n - 1, before ^ after), 'gap', gap)"
    return sums.select("place", F.explode(F.expr(
        f"if(gap = 1, array({without}, named_struct('key', xxhash64(n, all), 'gap', 0)), array({without}))")).alias("v")).select("place", "v.key", "v.gap")


def _proposed(keys: DataFrame) -> DataFrame:
    """``place, earlier``: for each line, the earliest line that shares a variant with it.

    Lines that agree without the same word differ in that word; a line that equals
    another without one word is shorter by it. Members of a group are only compared
    with its first place, so a group of any size gives a row per member.
    """
    groups = keys.groupBy("key", "gap").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    swapped = groups.where("gap > 0 and least <> most").select("key", "gap", F.col("least").alias("earlier"))
    both = keys.groupBy("key").agg(
        F.min(F.expr("if(gap = 0, place, null)")).alias("shorter"), F.min(F.expr("if(gap > 0, place, null)")).alias("longer")).where("shorter is not null and longer is not null")
    changed = keys.join(swapped, ["key", "gap"]).where("earlier < place").select("place", "earlier")
    lengths = keys.join(both, "key").select("place", F.expr("if(gap = 0, longer, shorter)").alias("earlier")).where("earlier < place")
    return changed.unionAll(lengths).groupBy("place").agg(F.min("earlier").alias("earlier"))


def one_edit(a: str, b: str) -> Column:
    """Whether two different word arrays are one insertion, deletion or substitution apart.

    The words before the first difference and those after the last one must leave
    at most one word of the longer line.
    """
    short = f"least(size({a}), size({b}))"

    def agree(x: str, y: str) -> str:
        return f"coalesce(nullif(array_position(zip_with(slice({x}, 1, {short}), slice({y}, 1, {short}), (p, q) -> p = q), false), 0) - 1, {short})"

    return F.expr(f"({agree(a, b)}) + ({agree(f'reverse({a})', f'reverse({b})')}) >= greatest(size({a}), size({b})) - 1 and abs(size({a}) - size({b})) <= 1")


def near_lines(docs: DataFrame, unique: DataFrame) -> DataFrame:
    """``place, earlier`` of the distinct lines that have an earlier line one word edit away, the earliest such."""
    candidates = stored(_candidates(docs, _with_partner(unique)).dropDuplicates(["place"]), "candidates")
    pairs = _proposed(stored(variants(candidates), "variants"))
    first = candidates.select("place", F.col("words").alias("a"))
    second = candidates.select(F.col("place").alias("earlier"), F.col("words").alias("b"))
    return pairs.join(first, "place").join(second, "earlier").where(one_edit("a", "b")).select("place", "earlier")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """The documents without lines that an earlier line repeats, exactly or but for one word.

    Lines end at line feeds; their words are runs between ASCII white space. Earlier
    means a smaller doc_id, then a smaller line number. A line goes if an earlier
    line has the same words, or if both have at least ``LEAST_WORDS`` words and one
    inserted, deleted or replaced word tells them apart, whether or not that earlier
    line itself stays. Lines without a word stay; a text of which no line with a word
    stays is empty. Null texts stay null.

    Rows that repeat an id and its text are one document: what stays, stays in all
    of them. Rows that share an id but not the text, and rows without an id, which
    come last, are ordered by a hash of their text. All columns stay in order;
    ``counts`` names two more, the numbers of lines with a word before and after.
    """
    kept_docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (counts or ())])
    plain, named = numbered(kept_docs)
    doc_id, text = named[doc_id], named[text]
    marked = plain.withColumn("_doc", _document(doc_id, text))
    found = marked.select(F.col("_doc").alias("doc"), F.col(text).alias("text")).where("text is not null")
    unique = stored(_unique(lines(found)), "lines")
    kept = unique.select("place").join(near_lines(found, unique), "place", "left_anti")
    # the numbers of a document's lines that stay, then spread over all its line numbers
    of_doc = kept.select(F.expr(_doc_of("place")).alias("_doc"), F.expr(_line_no("place")).alias("no")).groupBy("_doc").agg(F.array_sort(F.collect_set("no")).alias("_kept"))
    spread = "flatten(transform(_kept, (k, i) -> concat(array_repeat(false, k - if(i > 0, get(_kept, i - 1) + 1, 0)), array(true))))"
    blank = f"not (l rlike '[^{SPACE[1:-2]}]')".replace("\\", "\\\\")
    with_lines = (
        marked.join(of_doc, "_doc", "left")
        .withColumn("_stays", F.expr(f"coalesce({spread}, cast(array() as array<boolean>))"))
        .withColumn("_lines", F.split(text, "\n"))
        .withColumn("_left", F.expr(f"filter(_lines, (l, i) -> coalesce(get(_stays, i), false) or {blank})")))
    if counts:
        with_lines = with_lines.withColumn("_n", F.expr(f"size(filter(_lines, l -> not ({blank})))"))
    none = F.expr(f"_kept is null and exists(_lines, l -> not ({blank}))")
    new_text = F.when(F.col(text).isNull(), None).when(none, "").otherwise(F.array_join("_left", "\n"))
    more = [
        F.coalesce(F.when(F.col(text).isNull(), 0).otherwise(F.col("_n")), F.lit(0)).cast("long").alias(counts[0]),
        F.coalesce(F.size("_kept"), F.lit(0)).cast("long").alias(counts[1])] if counts else []
    return with_lines.select(*[(new_text if c == text else F.col(c)).alias(name) for name, c in named.items()], *more)
