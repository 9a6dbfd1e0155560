"""Personal data by bootstrapped contextual extraction (operator 7), in DataFrame functions only.

Seeds are well-formed e-mail addresses, IPs, payment cards, phone numbers and keys of known formats (kind ``secret``).
Other tokens of an identifier's shape are unknown at first. Long random-looking ones are hopeful where a credential is named
just before them (``token = "``, ``api key:``); such names are seeds of contexts, as keys are seeds of instances, and without
either no number of random-looking values makes a context trusted. An instance's lexical patterns are what stands around it: its last word with a mark behind it (``token = "``), its last two words,
and either with the mark that follows the instance; words and marks are kept, white space isn't. Instances and patterns
make a bipartite graph whose scores are refined in turns:

* An instance is sure if it is a seed or a pattern that is trusted extracts it. It speaks against a pattern if it
  isn't sure and one of the two words before it names what isn't personal (``sha256:``, ``the hash is``) and no credential
  is named after that, or if it also stands in an ordinary context: one of ``SUPPORT`` distinct instances or more of
  which none is sure or hopeful.
* A pattern is trusted if it extracts ``SUPPORT`` distinct sure or hopeful instances or more, no fewer than unknown
  ones, and they are ``CONFIDENCE`` of them together with those that speak against it.

Turns end when no pattern is added; trusted patterns only grow in number, so they do. What they extract beyond the
seeds is added as kind ``found``.

Spans count code points from 0, ends are exclusive. Defined results: null and empty texts have no spans; very long
texts are read whole, contexts have no limit in characters, and long runs of digits or letters cost linear time and no
stack; equal scores need no order, as all patterns that qualify are trusted; every row gets one row, repeated rows alike;
instances are counted once however often a row is repeated; an empty table gives an empty result; a null id is kept.
Columns beyond id and text are not read; ``redact`` returns all of them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import cut_lineage, distinct_names, read_table, whole_rows

_LOCAL = "A-Za-z0-9._%+-"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Kind: a cheap test of the text, and the pattern; ``\G`` is where the last match ended.
KINDS: dict[str, tuple[Callable[[Column], Column], str]] = {
    "email": (lambda t: t.contains("@"), rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (lambda t: t.contains("."), r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": (lambda t: t.isNotNull(), r"[0-9]++(?:[ -][0-9]++)*+"),
    "phone": (lambda t: t.contains("+"), r"\+[0-9][ ().0-9-]+[0-9]"),
}
SECRET, FOUND = "secret", "found"
#: A token of an identifier's shape: with a digit, at least six characters (checked apart).
CANDIDATE = r"(?<![A-Za-z0-9._%+@-])(?=[A-Za-z._%+@-]*+[0-9])[A-Za-z0-9._%+@-]*[A-Za-z0-9]"
CANDIDATE_LENGTH = 6
# Public formats of keys.
KEYS = (
    "AKIA[0-9A-Z]{16}",
    "ASIA[0-9A-Z]{16}",
    "AIza[0-9A-Za-z_-]{35}",
    "gh[pousr]_[0-9A-Za-z]{36,}",
    "glpat-[0-9A-Za-z_-]{20,}",
    "sk_(?:live|test)_[0-9A-Za-z]{16,}",
    "xox[abprs]-[0-9A-Za-z-]{10,}",
    r"eyJ[0-9A-Za-z_-]{10,}\.eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}",
)
# Words before what isn't personal.
IMPERSONAL = "blob build checksum commit crc32 digest doi etag fingerprint guid hash integrity isbn issn md5 part revision sha sha1 sha256 sha512 tree uuid version".split()
# Ends of names of credentials, parts of names that are ones as a whole, and words that make a key one.
CREDENTIALS = "apikey credential credentials passcode passphrase passwd password secret secrets token tokens".split()
CREDENTIAL_PARTS = "auth authorization bearer pwd".split()
KEY_OF = "access account api auth encryption license private secret session signing".split()
#: A hopeful token: so many letters and digits, which alternate.
HOPEFUL_LENGTH, HOPEFUL = 20, "^[0-9]*+(?:[A-Za-z]++[0-9]++){3,}+[A-Za-z]*+$"
#: Marks behind a word that make it a pattern by itself.
_MARKS = r"[:=(\[{<\"'#]"
_W, _NO_W = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
CONFIDENCE = 0.9
SUPPORT = 3
#: Parts of a pattern's or an instance's rows in joins, so that none needs a task for itself.
SALTS = 8
_SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string,before:string,after:string>"
_SURE, _HOPEFUL, _UNKNOWN, _AGAINST = 2, 1, 0, -1


def running(values: Column, merge: Callable[[Column, Column], Column], identity: int) -> Column:
    """Inclusive running fold of an array of longs, in blocks of the root of its size."""
    start = F.lit(identity).cast("long")
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    fold = lambda array, zero: F.aggregate(array, F.array(zero), lambda acc, x: F.array_append(acc, merge(F.element_at(acc, -1), x)))
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / block).cast("int") - 1), lambda i: F.slice(values, i * block + 1, block))
    bases = fold(F.transform(blocks, lambda b: F.aggregate(b, start, merge)), start)
    folded = F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), lambda b, base: F.slice(fold(b, base), F.lit(2), F.size(b)))
    return F.when(F.size(values) > 0, F.flatten(folded)).otherwise(F.array().cast("array<bigint>"))


def located(df: DataFrame, name: str, test: Column, pattern: str, rank: int) -> DataFrame:
    """Adds the array of spans of a pattern's matches in ``_text``.

    ``before`` is the text up to a span from the end of the last match but one, ``after`` goes on to the next match.
    """
    text, m, p = F.col("_text"), f"_m_{name}", f"_p_{name}"
    df = df.withColumn(m, F.when(test, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    lengths = F.zip_with(F.slice(p, F.lit(1), F.size(m)), F.col(m), lambda a, x: (F.length(a) + F.length(x)).cast("long"))
    df = df.withColumn(f"_l_{name}", F.when(F.size(m) > 0, running(lengths, lambda a, b: a + b, 0)))

    def span(i: Column) -> Column:
        value, end = F.get(m, i), F.get(f"_l_{name}", i)
        ahead = F.when(i > 0, F.concat(F.get(p, i - 1), F.get(m, i - 1))).otherwise(F.lit(""))
        return F.struct((end - F.length(value)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(name).alias("kind"), value.alias("value"), F.concat(ahead, F.get(p, i)).alias("before"), F.get(p, i + 1).alias("after"))

    spans = F.transform(F.sequence(F.lit(0), F.size(m) - 1), span)
    return df.withColumn(name, F.when(F.size(m) > 0, spans).otherwise(F.array().cast(f"array<{_SPAN}>"))).drop(m, p, f"_l_{name}")


def _valid(kind: str) -> Callable[[Column], Column]:
    digits = lambda s: F.regexp_replace(s["value"], "[^0-9]", "")
    return {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["value"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": lambda s: F.length(digits(s)).between(12, 19) & F.call_function("luhn_check", digits(s)),
        "phone": lambda s: F.length(digits(s)).between(9, 15),
    }[kind]


def _patterns(s: Column) -> Column:
    """Hashes of a span's lexical patterns."""
    plain = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"\s++", " "), rf" ?+({_NO_W}) ?+", "$1"))
    one = F.regexp_extract(s["before"], rf"(?<!{_W}){_W}++{_NO_W}*+\z", 0)
    two = F.regexp_extract(s["before"], rf"(?<!{_W}){_W}++{_NO_W}++{_W}++{_NO_W}*+\z", 0)
    left = F.array(F.when(one.rlike(_MARKS), plain(one)), F.when(two != "", plain(F.concat(F.lit("2 "), two))))
    mark = F.regexp_extract(s["after"], r"^\s*+([^\s\p{L}\p{N}_])", 1)
    both = F.transform(left, lambda c: F.when(mark != "", F.concat(c, F.lit("\n"), mark)))
    return F.transform(F.array_compact(F.concat(left, both)), lambda c: F.xxhash64(c))


def _state(s: Column) -> Column:
    """What is known of a span before any turn; of the two words before it the nearer one decides."""
    word = lambda far: F.lower(F.regexp_extract(s["before"], rf"(?<!{_W})({_W}++){far}{_NO_W}*+\z", 1))
    one, two = word(""), word(rf"{_NO_W}++{_W}++")
    named = lambda c: c.rlike(rf"(?:{'|'.join(CREDENTIALS)})$|(?:^|_)(?:{'|'.join(CREDENTIAL_PARTS)})$|(?:{'|'.join(KEY_OF)})_?key$")
    key = (one == "key") & two.isin(KEY_OF)
    credential = named(one) | key | (named(two) & ~one.isin(IMPERSONAL))
    hopeful = (F.length(s["value"]) >= HOPEFUL_LENGTH) & s["value"].rlike(HOPEFUL)
    against = one.isin(IMPERSONAL) | (two.isin(IMPERSONAL) & ~credential)
    return F.when(s["kind"] != FOUND, _SURE).when(against, _AGAINST).when(hopeful & credential, _HOPEFUL).otherwise(_UNKNOWN)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "end", "kind")]))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, email, ip, card, phone, base, secrets, _seen) for every row.

    ``base`` has the spans of the four kinds in order of start, then kind; ``_seen`` all instances with their patterns;
    ``_key`` tells rows of one id but other texts apart.
    """
    df = distinct_names(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    df = df.withColumn("_key", _row_key(F.col("_text")))
    for rank, (kind, (test, pattern)) in enumerate(KINDS.items()):
        df = located(df, kind, test(F.col("_text")), pattern, rank)
        df = df.withColumn(kind, F.filter(kind, _valid(kind)))
    df = located(df, FOUND, F.col("_text").rlike("[0-9]"), CANDIDATE, len(KINDS) + 1)
    df = df.withColumn("_base", F.array_sort(F.concat(*KINDS)))
    clear = F.filter(FOUND, lambda c: (F.length(c["value"]) >= CANDIDATE_LENGTH) & ~F.exists("_base", lambda s: (s["start"] <= c["start"]) & (c["end"] <= s["end"])))  # one within a seed is no instance of its own
    df = df.withColumn("_others", F.when(F.size(FOUND) > 0, clear).otherwise(F.col(FOUND)))
    is_key = lambda s: s["value"].rlike(f"^(?:{'|'.join(KEYS)})$")
    known = lambda s: s.withField("kind", F.when(is_key(s), F.lit(SECRET)).otherwise(F.lit(FOUND))).withField("rank", F.when(is_key(s), len(KINDS)).otherwise(len(KINDS) + 1))
    df = df.withColumn("_others", F.transform("_others", known))
    seen = F.transform(F.concat("_base", "_others"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.xxhash64(s["value"]).alias("instance"), _patterns(s).alias("patterns"), _state(s).alias("state")))
    secrets = F.filter("_others", lambda s: s["kind"] == SECRET)
    return df.select("doc_id", "_key", *[_plain(F.col(k)).alias(k) for k in KINDS], _plain(F.col("_base")).alias("base"), _plain(secrets).alias("secrets"), seen.alias("_seen"))


def _row_key(text: Column) -> Column:
    return F.struct(F.xxhash64("doc_id", text).alias("a"), F.xxhash64(text, F.lit(1), "doc_id").alias("b"))


def _salted(big: DataFrame, small: DataFrame, key: str, other: str, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small``, which has one row a key: rows of a key are dealt by ``other`` to ``SALTS`` parts."""
    parts = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")).join(parts, [key, "_salt"], how).drop("_salt")


def trusted_patterns(seen: DataFrame) -> DataFrame:
    """Patterns (column pattern) to be trusted, from rows (pattern, instance, state)."""
    strongest = F.when(F.max("state") == _SURE, _SURE).when(F.min("state") == _AGAINST, _AGAINST).otherwise(F.max("state"))
    states = cut_lineage(seen.groupBy("pattern", "instance").agg(F.max("state").alias("most"), F.min("state").alias("state")))
    # fewer distinct instances neither make a pattern nor an ordinary context
    wide = states.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT).select("pattern")
    edges = cut_lineage(_salted(states, wide, "pattern", "instance"))
    of_instance = edges.select("instance", F.explode(F.array("most", "state")).alias("state")).groupBy("instance").agg(strongest.alias("state"))
    known, trusted = cut_lineage(_salted(edges.select("pattern", "instance"), of_instance, "instance", "pattern")), None
    positive, unsure = F.col("state") >= _HOPEFUL, F.col("state") < _SURE
    while True:
        ordinary = cut_lineage(known.groupBy("pattern").agg(F.max("state").alias("most")).filter(F.col("most") < _HOPEFUL).select("pattern"))
        against = _salted(known.filter(unsure), ordinary, "pattern", "instance").select("instance").distinct().withColumn("elsewhere", F.lit(True))
        judged = _salted(known, cut_lineage(against), "instance", "pattern", "left")
        bad = (F.col("state") == _AGAINST) | (unsure & F.coalesce("elsewhere", F.lit(False)))
        scores = judged.groupBy("pattern").agg(F.count_if(positive & ~bad).alias("support"), F.count_if(bad).alias("against"), F.count_if(~positive & ~bad).alias("unknown"))
        enough = (F.col("support") >= SUPPORT) & (F.col("support") >= F.col("unknown")) & (F.col("support") >= CONFIDENCE * (F.col("support") + F.col("against")))
        now = scores.filter(enough).select("pattern")
        if trusted is not None:
            now = now.unionByName(trusted).distinct()
        now = cut_lineage(now)
        if now.count() == (0 if trusted is None else trusted.count()):
            return now
        trusted = now
        reached = _salted(known.filter(unsure & (F.col("state") > _AGAINST)), trusted, "pattern", "instance").select("instance").distinct().withColumn("reached", F.lit(True))
        turned = _salted(known, cut_lineage(reached), "instance", "pattern", "left")
        known = cut_lineage(turned.select("pattern", "instance", F.when(F.col("reached"), _SURE).otherwise(F.col("state")).alias("state")))


def _discovered(found: DataFrame) -> DataFrame | None:
    """(_key, more): the spans that trusted patterns extract beyond the seeds; None if there are none."""
    seen = found.select("_key", F.explode("_seen").alias("s")).select("_key", "s.*").withColumn("pattern", F.explode("patterns"))
    trusted = trusted_patterns(seen.select("pattern", "instance", "state"))
    if trusted.isEmpty():
        return None
    span = F.struct("start", F.lit(len(KINDS) + 1).alias("rank"), "end", F.lit(FOUND).alias("kind"))
    fresh = seen.filter(F.col("state").between(_UNKNOWN, _HOPEFUL)).select("_key", "pattern", "instance", span.alias("s"))
    more = _salted(fresh, trusted, "pattern", "_key")
    return cut_lineage(more.groupBy("_key").agg(F.collect_set("s").alias("more")))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, email, ip, card, phone, base, spans) for every row; spans are all of them in order."""
    found = cut_lineage(base_spans(docs))
    more, sure = _discovered(found), F.concat("base", "secrets")
    if more is not None:
        found = found.join(more, "_key", "left")
        sure = F.when(F.col("more").isNotNull(), F.concat(sure, "more")).otherwise(sure)
    return found.select("doc_id", "_key", *KINDS, "base", F.array_sort(sure).alias("spans"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars, where there is one, follows."""
    rows = whole_rows(docs, "doc_id", "text")
    found = cut_lineage(personal_data(rows).filter(F.size("spans") > 0).select("_key", "spans").dropDuplicates(["_key"]))
    spans, until = F.col("spans"), F.col("until")
    keyed = rows.select(_row_key(F.coalesce("text", F.lit(""))).alias("_key"), "row")  # the text goes once, within its row
    df = keyed.join(found.hint("shuffle_hash"), "_key", "left").withColumn("text", F.col("row").getField("text")).withColumn("until", running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0))
    # each span with the end of what stands before it; overlapped ones add nothing
    cut = F.transform(
        F.sequence(F.lit(0), F.size(spans) - 1),
        lambda i: F.struct(F.when(i > 0, F.get(until, i - 1)).otherwise(F.lit(0)).alias("from"), F.get(spans, i)["start"].alias("to"), F.get(spans, i)["kind"].alias("kind")),
    )
    pieces = F.transform(F.filter(cut, lambda c: c["from"] <= c["to"]), lambda c: F.concat(F.substring(F.col("text"), (c["from"] + 1).cast("int"), (c["to"] - c["from"]).cast("int")), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    rest = F.substring(F.col("text"), (F.element_at(until, -1) + 1).cast("int"), F.lit(2**31 - 1))
    df = df.withColumn("clean", F.when(spans.isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest)))
    old = lambda c: F.col("row").getField(c)
    new = {"text": F.col("clean")} | ({"n_chars": F.when(spans.isNull(), old("n_chars")).otherwise(F.length("clean").cast("long"))} if "n_chars" in docs.columns else {})
    return df.select(*[new.get(c, old(c)).alias(c) for c in docs.columns])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    found = personal_data(read_table(spark, sf_dir, "documents"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
