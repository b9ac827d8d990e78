"""Secret scans with linked credentials (operator 5), DataFrame functions only.

Strong finds stand alone: assignments to secret-like names, access identifiers and long hex
runs. Weak candidates - user names or key identifiers, unassigned random-looking tokens, and
endpoints - mean nothing alone. They are linked by an interval join: each part spans an
interval of code points, its scope reaches ``scope_chars`` beyond either end, and parts join
when one lies in the other's scope. A weak candidate is reported only if parts of the other
two roles complement it: an identifier needs a secret, a token needs an identifier or an
endpoint, an endpoint needs both an identifier and a secret.

Positions come from regular expressions only: a lazy prefix and the pattern, taken repeatedly,
give the gap and the length of each match, and running sums of those give its place.

Defined cases: a null or empty text has no finds; a text of any length is scanned whole, in time
that grows with its length and its finds; each row is scanned by itself, so repeated
rows and ids, null ids and ties change nothing; positions count code points, ends are
exclusive; an empty table gives an empty result; other columns are kept by ``redact_secrets``
and ignored by the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.llm.text import pinned, text_keys

#: Kind, role, pattern (group 1: the value), least length of the value, what the
#: value must hold besides. The first three are strong and in the order in which equal starts
#: are listed; the rest are weak.
STRONG = (
    ("assign", "secret", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, ()),
    ("access", "identity", r"(AKIA[A-Z0-9]+)", 16, ()),
    ("hex", "secret", r"([0-9a-f]{32,})", 32, ()),
)
WEAK = (
    ("user", "identity", r"\b(?i:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@-]+)", 3, ()),
    ("opaque", "secret", r"([A-Za-z0-9+/_=-]{20,})", 20, ("[0-9]", "[A-Z]", "[a-z]")),
    ("endpoint", "endpoint", r"((?:https?|ftp|ssh|postgres(?:ql)?|mysql|redis|mongodb|amqps?)://[^\s\"'<>]+)", 10, ()),
)
#: Kinds whose value follows a name.
NAMED = ("assign", "user")
ORDER = {kind: i for i, (kind, *_) in enumerate(STRONG + WEAK)}
ROLE = {kind: role for kind, role, *_ in STRONG + WEAK}
SCOPE_CHARS = 200
MARK = "[SECRET]"


def _matches(text: Column, pattern: str, own_value: bool) -> Column:
    """For each match of the pattern in order: the gap before it, the match and its value. The
    arrays are worked out once a text, before anything looks at one match."""
    # The end of the text ends the last gap: without it every place after the last match would
    # be tried as the beginning of a gap that leads nowhere.
    group = lambda g: F.regexp_extract_all(text, F.lit(f"(?s)(.*?)(?:({pattern})|\\z)"), F.lit(g))
    named = [group(1).alias("gap"), group(2).alias("all")] + ([group(3).alias("value")] if own_value else [])
    return F.arrays_zip(*named)


def find_parts(texts: DataFrame, kinds) -> DataFrame:
    """(k1, k2, kind, start, stop, first, last) of all finds of the kinds, in code points and
    (first, last) in bytes. texts: k1, k2, text, distinct."""
    found = []
    for kind, _, pattern, least, holds in kinds:
        own_value = kind in NAMED  # else the value is the match
        some = texts.where(F.col("text").rlike(pattern)).select("k1", "k2", F.posexplode(_matches(F.col("text"), pattern, own_value)).alias("i", "m"))
        before = Window.partitionBy("k1", "k2").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        up_to = lambda size: F.sum(size("m.gap") + size("m.all")).over(before).cast("long")
        sized = some.select("k1", "k2", F.lit(kind).alias("kind"), "m", up_to(F.length).alias("stop"), up_to(F.octet_length).alias("last"))
        value = F.col("m.value" if own_value else "m.all")
        right = sized.where(F.length(value) >= least)
        for need in holds:
            right = right.where(value.rlike(need))
        found.append(right.select(
            "k1", "k2", "kind", (F.col("stop") - F.length("m.all")).alias("start"), "stop",
            (F.col("last") - F.octet_length("m.all")).alias("first"), "last",
        ))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def link_parts(parts: DataFrame, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """The weak parts that complementary parts in scope confirm. Intervals meet in buckets
    of the scope's width, which hold few parts each (a part has a least length)."""
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
    weak = parts.where(F.col("kind").isin([k for k, *_ in WEAK])).withColumn("role", role[F.col("kind")])
    reach = F.sequence(F.floor((F.col("start") - scope_chars) / scope_chars), F.floor((F.col("stop") + scope_chars) / scope_chars))
    probe = weak.withColumn("bucket", F.explode(reach))
    held = parts.select(
        "k1", "k2", F.explode(F.sequence(F.floor(F.col("start") / scope_chars), F.floor((F.col("stop") - 1) / scope_chars))).alias("bucket"),
        F.col("start").alias("from"), F.col("stop").alias("to"), role[F.col("kind")].alias("other"), F.col("kind").isin([k for k, *_ in STRONG]).alias("strong"),
    )
    near = (F.col("from") < F.col("stop") + scope_chars) & (F.col("to") > F.col("start") - scope_chars)
    apart = (F.col("from") >= F.col("stop")) | (F.col("to") <= F.col("start"))  # a part doesn't confirm itself
    met = probe.join(held, ["k1", "k2", "bucket"]).where(near)
    any_of = lambda c: F.max(c.cast("int")) == 1
    has = lambda r: any_of(apart & (F.col("other") == r))
    over = any_of(~apart & F.col("strong"))  # a weak find on a strong one adds nothing
    seen = met.groupBy("k1", "k2", "kind", "role", "start", "stop", "first", "last").agg(has("identity").alias("i"), has("secret").alias("s"), has("endpoint").alias("e"), over.alias("over"))
    ok = (
        ((F.col("role") == "identity") & F.col("s"))
        | ((F.col("role") == "secret") & (F.col("i") | F.col("e")))
        | ((F.col("role") == "endpoint") & F.col("i") & F.col("s"))
    )
    return seen.where(ok & ~F.col("over")).select("k1", "k2", "kind", "start", "stop", "first", "last")


def find_secrets(docs: DataFrame, text="text", scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """(k1, k2, spans): for each distinct text with finds its spans (start, rank, kind, stop and
    the first and last byte), sorted. k1 and k2 identify the text. Written once."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    strong = "|".join(f"(?:{p})" for _, _, p, *_ in STRONG)
    weak = "|".join(f"(?:{p})" for _, _, p, *_ in WEAK)
    # Texts without any find end here; copies of a text are scanned once.
    able = docs.select(t.alias("text")).where(F.col("text").rlike(strong) | F.col("text").rlike(weak))
    able = able.groupBy(*text_keys(F.col("text"))).agg(F.first("text").alias("text"))
    able = pinned(able, "texts-with-parts")
    parts = pinned(find_parts(able, STRONG + WEAK), "secret-parts")
    strong_parts = parts.where(F.col("kind").isin([k for k, *_ in STRONG]))
    rank = F.create_map(*[F.lit(x) for pair in ORDER.items() for x in pair])
    spans = strong_parts.unionByName(link_parts(parts, scope_chars)).select("k1", "k2", F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "stop", "first", "last").alias("span"))
    return pinned(spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("span")).alias("spans")), "secret-spans")


def with_spans(docs: DataFrame, spans: DataFrame, text="text") -> DataFrame:
    """(__row: the document's columns, __spans: empty where nothing was found)."""
    k1, k2 = text_keys(F.col(f"`{text}`"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), k1.alias("k1"), k2.alias("k2"))
    none = F.array().cast(dict(spans.dtypes)["spans"])
    return own.join(spans, ["k1", "k2"], "left").select("__row", F.coalesce("spans", none).alias("__spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def _covered(spans: DataFrame) -> DataFrame:
    """(k1, k2, spans): the bytes (first, last) that the spans of a text cover, overlapping
    ones as one, in order."""
    each = spans.select("k1", "k2", F.explode("spans").alias("s")).select("k1", "k2", "s.first", "s.last")
    order = Window.partitionBy("k1", "k2").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    part = F.sum((F.coalesce(reached, F.lit(-1)) <= F.col("first")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = each.withColumn("part", part).groupBy("k1", "k2", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return pinned(runs.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans")), "covered-bytes")


def redact_secrets(docs: DataFrame, text="text", mark: str = MARK, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """The documents with every span replaced by ``mark``; overlapping spans become one."""
    joined = with_spans(docs, _covered(find_secrets(docs, text, scope_chars)), text)
    t, spans = F.col("__row")[text], F.col("__spans")
    # Bound to a name, the bytes and the spans are fetched once a text; a piece of the bytes is cut
    # in the time of its own length.
    piece = lambda raw, a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string")

    def pieces(x: Column) -> Column:
        raw, held, size = x["raw"], x["spans"], F.size(x["spans"])
        end = lambda i: F.coalesce(F.get(held, i - 1)["last"], F.lit(0))
        return F.transform(F.sequence(F.lit(0), size), lambda i: piece(raw, end(i), F.coalesce(F.get(held, i)["first"], x["size"])))

    bound = F.array(F.struct(t.cast("binary").alias("raw"), spans.alias("spans"), F.octet_length(t).cast("long").alias("size")))
    new = F.when(F.size(spans) == 0, t).otherwise(F.array_join(F.transform(bound, pieces)[0], mark))
    return joined.select(*[new.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns])


def scan_secrets(docs: DataFrame, doc_id="doc_id", text="text", scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """One row per document row: doc_id, spans (array of start, rank, kind, stop, and first and
    last byte, in order)."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = with_spans(narrow, find_secrets(narrow, "text", scope_chars), "text")
    return found.select(F.col("__row.doc_id").alias("doc_id"), F.col("__spans").alias("spans"))
