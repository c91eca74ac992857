"""Line de-duplication by a log-template tree (operator 8), in DataFrame operations only.

1. Each line of each whole text is split into tokens; a token with a digit is a variable
   field. The tree has a fixed depth: a line's leaf is its token count and its ``depth``
   leading tokens, variable fields generalised.
2. In a leaf of several different lines, the tokens that lines share most often at each
   position form the leaf's template; lines that agree with it in ``agree`` of all
   positions belong to it, so the other positions become variable fields too. Lines left
   over form the next template of the leaf, ``rounds`` times.
3. What is still left over is grouped by similarity to leading lines of the leaf, and each
   group votes on its template or takes its leading line for one, until no two lines that
   are left agree in ``agree`` of all positions; then a line is its own.
4. A template that recurs across documents stays in the document of least id and is dropped
   from all others.

Per leaf only counts by (position, token) are gathered, pre-aggregated before the shuffle;
a line or leaf of any frequency is a few combined rows. Documents meet no other documents.

Lines with fewer than ``min_tokens`` constant tokens, or more variable fields than constant
tokens, say too little to be a template. Of these, lines of ``min_bytes`` bytes (so that
scripts without spaces count alike) are compared as they are, with no field generalised, and
go if another document repeats them; shorter ones stay. Defined results: null texts stay null and
have no lines; an empty text has one empty line; rows that repeat a doc_id are one document
(a line recurs only across ids) and each row loses lines of its own text; rows with a null doc_id stay as they are; lines may be of
any length; an empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read

FIELD = "<*>"


def normalised(line) -> F.Column:
    """A line with single spaces between its tokens (cut at ASCII white space) and variable
    fields generalised."""
    return F.regexp_replace(spaced(line), r"(?:(?<= )|^)(?=[^ ]*[0-9])[^ ]+", FIELD)


def spaced(line) -> F.Column:
    return F.trim(F.regexp_replace(line, r"[ \t\r\x0B\f]+", " "))


def tokens_of(line) -> F.Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def telling(line, min_tokens: int) -> F.Column:
    """Whether a normalised line has the constant tokens of a template."""
    n = tokens_of(line)
    fields = F.when(line.contains(FIELD), F.size(F.filter(F.split(line, " "), lambda t: t == FIELD))).otherwise(0)
    return (n >= min_tokens) & (n - fields >= min_tokens) & (2 * (n - fields) >= n)


def exploded(docs: DataFrame, min_tokens: int, *keep) -> DataFrame:
    """The normalised lines of each text, with their numbers; a line of too many fields to be
    a template is not generalised and follows a line feed, which no other line holds.

    Most texts hold no digit and single spaces only: their lines are taken as they are.
    """
    lines = F.split("text", "\n")
    odd = F.col("text").rlike(r"[0-9\t\r\x0B\f]|  | \n|\n |^ | $")
    plain = F.zip_with(F.transform(lines, normalised), lines, lambda x, raw: F.when(
        x.contains(FIELD) & ~telling(x, min_tokens), F.concat(F.lit("\n"), spaced(raw))).otherwise(x))
    return docs.select(*keep, F.posexplode(F.when(odd, plain).otherwise(lines))
                       .alias("line_no", "line"))


def with_leaf(lines: DataFrame, depth: int, min_tokens: int, min_bytes: int) -> DataFrame:
    """Eligible lines with their leaf and hash; a line compared as it is has a leaf of its own."""
    line = F.col("line")
    whole = line.startswith("\n") | ~telling(line, min_tokens)
    return (lines.withColumn("whole", whole).where(~F.col("whole") | (F.octet_length(line) >= min_bytes))
            .withColumn("leaf", F.when(F.col("whole"), F.xxhash64(F.lit("\n"), "line"))
                        .otherwise(F.xxhash64(tokens_of(line), F.substring_index(line, " ", depth))))
            .withColumn("lhash", F.xxhash64("leaf", "line")))


def voted(lines: DataFrame, agree_percent: int) -> DataFrame:
    """(leaf, tmpl): the tokens that lines of a leaf share most often, if at enough positions."""
    counts = (lines.select("leaf", F.size("toks").alias("n"), F.posexplode("toks").alias("pos", "tok"))
              .groupBy("leaf", "n", "pos", "tok").agg(F.count("*").alias("c")).where("c > 1"))
    return (counts.groupBy("leaf", "n", "pos").agg(F.max(F.struct("c", "tok")).alias("m"))
            .groupBy("leaf", "n").agg(F.collect_list(F.struct("pos", "m.tok")).alias("tmpl"))
            .where(100 * F.size("tmpl") >= agree_percent * F.col("n")).drop("n"))


def fits(agree_percent: int) -> F.Column:
    """Whether ``toks`` agree with ``tmpl``."""
    hit = F.size(F.filter("tmpl", lambda x: F.element_at("toks", x["pos"] + 1) == x["tok"]))
    return 100 * hit >= agree_percent * F.size("toks")


def alike(a, b, percent: int) -> F.Column:
    """Whether two token lists of one length agree in ``percent`` of all positions."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return 100 * F.size(same) >= percent * F.size(a)


def leading(heads, percent: int) -> F.Column:
    """Those of ``heads(lhash, toks)`` that agree with none before them."""
    return F.aggregate(heads, F.slice(heads, 1, 0), lambda held, p: F.when(
        F.exists(held, lambda q: alike(q["toks"], p["toks"], percent)), held)
        .otherwise(F.concat(held, F.array(p))))


def split_large(live: DataFrame, agree_percent: int, large: int) -> DataFrame:
    """Groups of over ``large`` lines split by blocks of the positions not yet fixed in them.

    Lines that agree in ``agree`` of all positions miss ``misses`` at most, so of one block
    more than that they share one whole. A group that has fewer positions left open agrees
    as it is.
    """
    blocks = F.floor(F.size("toks") * (100 - agree_percent) / 100).cast("int") + 1
    sized = live.join(live.groupBy("g").agg(F.count("*").alias("c")).where("c > 1"), "g")
    big = (F.col("c") > large) & (F.size("free") >= blocks)
    b = F.col("b")
    cut = sized.where(big).select("g", "free", "lhash", "toks", blocks.alias("blocks"),
                                  F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b")).select(
        F.xxhash64("g", b, F.transform(F.filter("free", lambda x, i: i % F.col("blocks") == b),
                                       lambda x: F.get("toks", x))).alias("g"),
        F.filter("free", lambda x, i: i % F.col("blocks") != b).alias("free"), "lhash", "toks")
    return sized.where(~big).select("g", "free", "lhash", "toks").union(cut)


def similar_lines(scratch: Scratch, rest: DataFrame, depth: int, agree_percent: int,
                  heads: int = 64, large: int = 2048) -> DataFrame | None:
    """(lhash, tid) of lines that the votes by leaf leave over, or None if there are none.

    In each round up to ``heads`` lines of a group are its heads. Lines of one template agree
    with each other in twice ``agree`` less one at least: those that agree that far with a
    leading head vote on a template, and those that agree in ``agree`` with a leading head
    have it for one; a line takes the larger. A head that no line agrees with is its own. So
    every round names lines or settles a head of each group, until no two lines are left.
    """
    live = scratch.cut(rest.select(
        F.col("leaf").alias("g"),
        F.slice(F.sequence(F.lit(0), F.size("toks") - 1), depth + 1, F.size("toks")).alias("free"),
        "lhash", "toks"), "live-0")
    out, r = None, 0
    while not live.groupBy("g").count().where("count > 1").isEmpty():
        r += 1
        rows = scratch.cut(split_large(live, agree_percent, large), f"groups-{r}")
        slot = F.pmod(F.xxhash64("lhash", F.lit(r)), F.lit(heads)).alias("slot")
        # bounded: one head a slot
        picked = (rows.groupBy("g", slot).agg(F.min(F.struct("lhash", "toks")).alias("p"))
                  .groupBy("g").agg(F.sort_array(F.collect_list("p")).alias("p"))
                  .select("g", leading(F.col("p"), max(1, 2 * agree_percent - 100)).alias("wide"),
                          leading(F.col("p"), agree_percent).alias("near")))

        def of(found, percent):
            return F.transform(F.filter(found, lambda q: alike("toks", q["toks"], percent)), lambda q: q["lhash"])
        scored = scratch.cut(rows.join(picked, "g").select(
            "g", "free", "lhash", "toks", F.exists("near", lambda q: q["lhash"] == F.col("lhash")).alias("leads"),
            F.get(of("wide", max(1, 2 * agree_percent - 100)), 0).alias("w"),
            of("near", agree_percent).alias("near")), f"similar-{r}")
        mates = scored.where("w is not null").select(F.xxhash64("g", "w", F.lit(-r)).alias("leaf"), "lhash", "toks")
        first = F.get("near", 0)
        claims = (mates.join(voted(mates, agree_percent), "leaf").where(fits(agree_percent)).select("lhash", F.col("leaf").alias("tid"))
                  .union(scored.where(first.isNotNull()).select("lhash", F.xxhash64("g", first, F.lit(r)).alias("tid"))))
        best = claims.join(claims.groupBy("tid").agg(F.count("*").alias("c")).where("c > 1"), "tid") \
            .groupBy("lhash").agg(F.max(F.struct("c", "tid")).alias("m")).select("lhash", "m.tid")
        best = scratch.cut(best, f"best-{r}")
        named = scratch.cut(best.join(best.groupBy("tid").agg(F.count("*").alias("c")).where("c > 1"), "tid")
                            .select("lhash", "tid"), f"similar-named/{r}")
        out = named if out is None else out.union(named)
        met = scored.select("g", "lhash", F.explode("near").alias("head")).where("head <> lhash") \
            .select("g", F.col("head").alias("lhash")).distinct()
        live = scratch.cut(
            scored.where("not leads").select("g", "free", "lhash", "toks")
            .union(scored.where("leads").join(met, ["g", "lhash"], "left_semi").select("g", "free", "lhash", "toks"))
            .join(named, "lhash", "left_anti").select("g", "free", "lhash", "toks"), f"live-{r}")
        scratch.drop(f"live-{r - 1}", f"groups-{r}", f"similar-{r}", f"best-{r}")
    scratch.drop(f"live-{r}")
    return out


def leaf_templates(scratch: Scratch, lines: DataFrame, depth: int, agree_percent: int, rounds: int) -> DataFrame:
    """(lhash, tid): the template of each line of ``lines(leaf, lhash, toks)`` that has one."""
    rest, out = lines, None
    for r in range(1, rounds + 1):
        scored = scratch.cut(
            rest.join(voted(rest, agree_percent), "leaf", "left")
            .select("leaf", "lhash", "toks",
                    F.when(fits(agree_percent), F.xxhash64("leaf", F.lit(r)))
                    .alias("tid"),
                    # a leaf without a template has none in later rounds either
                    F.col("tmpl").isNotNull().alias("open")), f"templates-{r}")
        named = scored.where("tid is not null").select("lhash", "tid")
        out = named if out is None else out.union(named)
        rest = scored.where("tid is null and open").select("leaf", "lhash", "toks")
    similar = similar_lines(scratch, rest, depth, agree_percent)
    return out if similar is None else out.union(similar)


def dropped_lines(scratch: Scratch, docs: DataFrame, depth: int, min_tokens: int,
                  agree_percent: int, rounds: int, min_bytes: int) -> DataFrame:
    """(doc_id, th, gone): the numbers of the lines that each text, hashed to th, loses."""
    known = docs.where("doc_id is not null and text is not null") \
        .select("doc_id", "text", F.xxhash64("text").alias("th"))
    lines = scratch.cut(with_leaf(exploded(known, min_tokens, "doc_id", "th"), depth, min_tokens, min_bytes)
                        .select("doc_id", "th", "line_no", "leaf", "lhash"), "lines")
    distinct = scratch.cut(lines.groupBy("leaf", "lhash").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "distinct")
    crowded = distinct.groupBy("leaf").agg(F.min("lhash").alias("a"), F.max("lhash").alias("b")) \
        .where("a < b").select("leaf")
    # the tokens of one occurrence of each line of a leaf with several
    wanted = (lines.join(distinct.join(crowded, "leaf", "left_semi")
                         .select("lhash", F.col("lo").alias("doc_id")), ["lhash", "doc_id"])
              .groupBy("doc_id", "th").agg(F.collect_set("line_no").alias("wanted")))
    seen = (exploded(known.join(wanted, ["doc_id", "th"]), min_tokens, "doc_id", "wanted")
            .where(F.array_contains("wanted", F.col("line_no"))))
    tokens = scratch.cut(with_leaf(seen, depth, min_tokens, min_bytes)
                         .select("leaf", "lhash", F.split("line", " ").alias("toks"))
                         .dropDuplicates(["lhash"]), "tokens")
    named = leaf_templates(scratch, tokens, depth, agree_percent, rounds)
    of_line = distinct.join(named, "lhash", "left").select(
        "lhash", F.coalesce("tid", "lhash").alias("tid"), "lo", "hi")
    recurring = of_line.groupBy("tid").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")) \
        .where("lo < hi").select("tid", "lo")
    bad = of_line.select("lhash", "tid").join(recurring, "tid").select("lhash", "lo")
    return scratch.cut(lines.join(bad, "lhash").where("doc_id <> lo")
                       .groupBy("doc_id", "th").agg(F.collect_set("line_no").alias("gone")), "gone")


def dedup_lines(docs: DataFrame, depth: int = 3, min_tokens: int = 6, agree_percent: int = 80,
                rounds: int = 3, min_bytes: int = 60) -> DataFrame:
    """``docs`` with recurring lines dropped from ``text``, and n_lines and n_dropped."""
    scratch = Scratch(docs.sparkSession, "lines")
    gone = dropped_lines(scratch, docs, depth, min_tokens, agree_percent, rounds, min_bytes) \
        .select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("gone").alias("_gone"))
    scratch.drop("lines", "distinct", "tokens", "similar-named", *(f"templates-{r}" for r in range(1, rounds + 1)))
    # the row travels as one struct, so that no column of it clashes with a computed one
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    lines = F.split("text", "\n")
    here = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_th"))
    kept = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(
        F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n"))
    own = [kept.alias("text") if c == "text" else F.col("_row")[c].alias(c)
           for c in docs.columns if c not in ("n_lines", "n_dropped")]
    none = F.col("text").isNull()
    return rows.join(gone, here, "left").select(
        *own, F.when(none, 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.coalesce(F.size("_gone"), F.lit(0))).cast("long").alias("n_dropped"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the remaining text of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")


def oracle_sql(depth: int = 3, min_tokens: int = 6, agree_percent: int = 80, rounds: int = 3) -> str:
    """The same in DuckDB SQL, on token strings and lists instead of hashes."""
    sql = [f"""with raw as (select doc_id, md5(text) th, unnest(string_split(text, chr(10))) line,
      generate_subscripts(string_split(text, chr(10)), 1) line_no
    from (select distinct doc_id, text from documents where doc_id is not null and text is not null)),
    tok as (select doc_id, th, line_no, list_transform(string_split(trim(regexp_replace(line,
      '[ \\t\\r\\x0B\\f]+', ' ', 'g')), ' '), lambda t: case when regexp_matches(t, '[0-9]') then '{FIELD}' else t end) toks
      from raw),
    lines as (select *, len(toks) n, array_to_string(list_slice(toks, 1, {depth}), ' ') lead
      from tok where len(list_filter(toks, lambda t: t <> '{FIELD}')) >= {min_tokens}
        and 2 * len(list_filter(toks, lambda t: t = '{FIELD}')) <= len(toks)),
    dist as (select n, lead, toks, min(doc_id) lo, max(doc_id) hi from lines group by all),
    rest1 as (select n, lead, toks from dist
      where (n, lead) in (select (n, lead) from dist group by n, lead having count(*) > 1))"""]
    for r in range(1, rounds + 1):
        sql.append(f"""
    cnt{r} as (select n, lead, pos, tok, count(*) c from (select n, lead, unnest(toks) tok,
        generate_subscripts(toks, 1) pos from rest{r}) group by all having count(*) > 1),
    mode{r} as (select n, lead, pos, tok from cnt{r}
      qualify row_number() over (partition by n, lead, pos order by c desc, encode(tok) desc) = 1),
    open{r} as (select n, lead from mode{r} group by n, lead having 100 * count(*) >= {agree_percent} * n),
    hit{r} as (select x.n, x.lead, x.toks, count(m.pos) h from (select n, lead, toks, unnest(toks) tok,
        generate_subscripts(toks, 1) pos from rest{r} where (n, lead) in (select (n, lead) from open{r})) x
      left join mode{r} m on m.n = x.n and m.lead = x.lead and m.pos = x.pos and m.tok = x.tok
      group by x.n, x.lead, x.toks),
    named{r} as (select n, lead, toks, '{r}' tid from hit{r} where 100 * h >= {agree_percent} * n),
    rest{r + 1} as (select n, lead, toks from hit{r} where 100 * h < {agree_percent} * n)""")
    sql.append(f"""
    named as ({' union all '.join(f'from named{r}' for r in range(1, rounds + 1))}),
    ofline as (select d.*, coalesce(m.tid, 'own ' || array_to_string(d.toks, ' ')) tid
      from dist d left join named m on m.n = d.n and m.lead = d.lead and m.toks = d.toks),
    rec as (select n, lead, tid, min(lo) lo from ofline group by n, lead, tid having min(lo) < max(hi)),
    bad as (select o.n, o.toks, r.lo from ofline o join rec r on r.n = o.n and r.lead = o.lead and r.tid = o.tid),
    gone as (select l.doc_id, l.th, list(distinct l.line_no) g from lines l join bad b on b.n = l.n and b.toks = l.toks
      where l.doc_id <> b.lo group by l.doc_id, l.th)
    select d.doc_id, case when text is null then 0 else len(string_split(text, chr(10))) end::bigint n_lines,
      coalesce(len(g), 0)::bigint n_dropped,
      case when g is null then text else array_to_string(list_filter(string_split(text, chr(10)),
        lambda x, i: not list_contains(g, i)), chr(10)) end as text
    from documents d left join gone on gone.doc_id = d.doc_id and gone.th = md5(d.text)""")
    return ",".join(sql)
