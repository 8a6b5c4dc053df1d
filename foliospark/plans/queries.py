"""Queries of the document operators over the driver's tables, each with its SQL twin.

The tables' texts have no bullets, page numbers, blank lines or tags; both sides decorate lines by the
same rule of doc_id and line number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..functions.sizes import spread
from ..operators import correction as G, corpus as E, lines as L, pages as B, results as H, speech as I, training as R

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


# ---- decoration, for both engines

WS = T.WS
AHEAD = "(?=[MDCLXVI])"  # RE2 has no look-around: what it says is a condition beside the pattern
ROMAN = T.ROMAN.replace(AHEAD, "")
MARK = T.LIST_MARKER.replace(AHEAD, "")


def s_(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


LINES = """raw as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
ex as (select doc_id as book_id, cast(pos - 1 as bigint) as line_no, ls[pos] as l from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as pos from raw)),
lines as (select book_id, line_no, case (book_id * 31 + line_no) % 13 when 0 then '  ' || line_no || ' ' when 1 then '•' when 2 then 'xiv.' when 3 then '' when 4 then '_____' when 5 then '- ' || l when 6 then '  ' || l || chr(9) || '  ' else l end as line from ex)"""


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.split_lines(documents(spark, sf_dir).select(F.col("doc_id").alias("book_id"), F.coalesce("text", F.lit("")).alias("text")), ["book_id"])
    return out.withColumn("line", F.expr(r"case (book_id * 31 + line_no) % 13 when 0 then concat('  ', line_no, ' ') when 1 then '•' when 2 then 'xiv.' when 3 then '' when 4 then '_____' when 5 then concat('- ', line) when 6 then concat('  ', line, '\t', '  ') else line end"))


TAGGED = """raw as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
ex as (select doc_id, cast(pos - 1 as bigint) as line_no, ls[pos] as l from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as pos from raw)),
lines as (select doc_id, line_no, case (doc_id * 7 + line_no) % 6 when 0 then '_START_SECTION_ ' || l when 1 then '_START_PARAGRAPH_' when 2 then l || ' _NEWLINE_ ' || l when 4 then '_START_ARTICLE_' else l end as line from ex)"""


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.split_lines(documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["doc_id"])
    return out.withColumn("line", F.expr("case (doc_id * 7 + line_no) % 6 when 0 then concat('_START_SECTION_ ', line) when 1 then '_START_PARAGRAPH_' when 2 then concat(line, ' _NEWLINE_ ', line) when 4 then '_START_ARTICLE_' else line end"))


def u_(salt: str, *key: str) -> str:
    return f"(('0x' || substr(md5('{salt}' || {' || '.join(repr(':') + ' || ' + k for k in key)}), 1, 8))::bigint / 4294967296.0::double)"


def dice_(place: int, *key: str) -> str:
    return f"(('0x' || substr(md5('noise' || {' || '.join(repr(':') + ' || ' + k for k in key)}), {8 * place + 1}, 8))::bigint / 4294967296.0::double)"


# ---- pages

TOKENS = r"tokens as (select doc_id, unnest(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-zA-Z]{2,}'))) as word from documents)"
DICT = r"dict as (select distinct lower(word) as word from (select unnest(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-zA-Z]{2,}'))) as word from benchmark))"
RATIO = f"{TOKENS}, {DICT}, r as (select doc_id, count(*) as tokens, count(dict.word) as known from tokens left join dict on lower(tokens.word) = dict.word group by doc_id), ratio as (select d.doc_id, d.text, coalesce(tokens, 0) as tokens, coalesce(known, 0) as known, case when coalesce(tokens, 0) = 0 then 0.0 else known / tokens end as ratio from documents d left join r using (doc_id))"


@query(f"with {TOKENS} select doc_id, word, count(*) as n from tokens group by doc_id, word")
def word_extract(spark, sf_dir):
    return B.word_counts(documents(spark, sf_dir), ["doc_id"])


@query(f"with {DICT} select word from dict")
def dictionary_build(spark, sf_dir):
    return B.build_dictionary(table(spark, sf_dir, "benchmark"))


@query(f"with {RATIO} select doc_id, cast(tokens as bigint) as tokens, cast(known as bigint) as known, round(ratio, 6) as ratio from ratio")
def valid_word_ratio(spark, sf_dir):
    return B.valid_word_ratio(documents(spark, sf_dir), dictionary_build(spark, sf_dir), ["doc_id"]).withColumn("ratio", F.round("ratio", 6))


@query(f"with {RATIO} select doc_id, case when length({s_('coalesce(text, ' + repr('') + ')')}) <= 10 then 'short' when ratio < 0.2 then 'garbled' else 'ok' end as route, case when length({s_('coalesce(text, ' + repr('') + ')')}) <= 10 or ratio < 0.2 then '' else coalesce(text, '') end as text, 0 as prob from ratio")
def page_route(spark, sf_dir):
    docs = documents(spark, sf_dir)
    out = docs.select("doc_id", "text").join(B.valid_word_ratio(docs, dictionary_build(spark, sf_dir), ["doc_id"]), "doc_id")
    out = out.withColumn("route", B.route(F.col("text"), F.col("ratio"), min_ratio=0.2))  # nothing recognises pages here
    return out.select("doc_id", "route", B.page_record(F.col("text"), F.col("route"), F.lit(None).cast("string")).alias("p")).select("doc_id", "route", "p.text", "p.prob")


# ---- lines

CLASSES = f"""stats as (select book_id, avg(length(line)) filter (length(line) > 0) as mean, stddev_pop(length(line)) filter (length(line) > 0) as std from lines group by book_id),
cls as (select book_id, line_no, line, cast(length(line) as bigint) as length, case when {s_('line')} = '' then 'Empty Line'
when regexp_full_match(upper({s_('line')}), '{ROMAN}') and contains('MDCLXVI', substr(upper({s_('line')}), 1, 1)) then 'Roman Numeral'
when length(line) < coalesce(mean * 0.5, 10.0) or length(line) - length(translate(line, '.-', '')) > 5 then 'Likely Short/Header' else 'Regular Line' end as class from lines join stats using (book_id)),
checked as (select *, class <> 'Regular Line' as "check" from cls)"""
KEPT = rf"""kept as (select * from checked where not ("check" and regexp_full_match(line, '[{WS}]*(\p{{Nd}}+|[A-Za-z]|_+)[{WS}]*')))"""
GLUED = rf"""a as (select *, row_number() over w as i, {s_('line')} as s, lead({s_('line')}) over w as follows, lag("check") over w as after from kept window w as (partition by book_id order by line_no)),
b as (select *, regexp_matches(s, '^{MARK}[{WS}]+') and not starts_with(s, '.') and s <> '' as item, regexp_full_match(s, '{MARK}') and s <> '' and s <> '.' and not "check" and coalesce(follows <> '', false) as bare from a),
c as (select *, min(case when not bare then i end) over r as e, first_value(case when not bare then item end ignore nulls) over r as base from b window r as (partition by book_id order by line_no rows between current row and unbounded following)),
g as (select *, sum(case when i = 1 or after or (base <> ((e - i) % 2 = 1)) then 1 else 0 end) over (partition by book_id order by line_no) as g from c),
h as (select *, min(line_no) over (partition by book_id, g) as head, max(line_no) over (partition by book_id, g) as tail from g),
glued as (select book_id, head as line_no, max(line) filter (line_no = head) || case when count(*) > 1 then ' ' || {s_(f"string_agg(case when line_no = tail then s else regexp_replace(line, '^[{WS}]+', '') end, ' ' order by line_no) filter (line_no > head)")} else '' end as line from h group by book_id, g, head)"""
TIDY = f"tidy as (select book_id, line_no, line from (select book_id, line_no, regexp_replace(regexp_replace(line, ' +', ' ', 'g'), chr(9) || '+', '', 'g') as line from SOURCE) where {s_('line')} <> '')"
BULLETED = rf"""p as (select *, row_number() over w as i, {s_('line')} as s, lead({s_('line')}) over w as follows from SOURCE window w as (partition by book_id order by line_no)),
q as (select *, regexp_full_match(s, '[\p{{Nd}}•◦∙·‣⁃-]') as b from p),
t as (select *, i - 1 - coalesce(max(case when not b then i end) over (partition by book_id order by line_no rows between unbounded preceding and 1 preceding), 0) as run from q),
merged as (select book_id, line_no, case when b and follows is not null then s || ' ' || follows else line end as line from t where run % 2 = 0)"""


@query(f"with {LINES} select book_id, line_no, line, cast(length(line) as bigint) as length from lines")
def line_lengths(spark, sf_dir):
    return book_lines(spark, sf_dir).withColumn("length", F.length("line").cast("long"))


@query(f"with {LINES} select book_id, cast(length(string_agg(line, chr(10) order by line_no)) as bigint) as chars, md5(string_agg(line, chr(10) order by line_no)) as digest from lines group by book_id")
def page_concat(spark, sf_dir):
    return books(spark, sf_dir).select("book_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


@query(f"with {LINES}, {CLASSES} select book_id, round(mean, 6) as mean, round(std, 6) as std, round(coalesce(mean * 0.5, 10.0), 6) as threshold from stats")
def line_stats(spark, sf_dir):
    return L.line_stats(book_lines(spark, sf_dir), ["book_id"]).select("book_id", *(F.round(c, 6).alias(c) for c in ("mean", "std", "threshold")))


@query(f"with {LINES} select book_id, line_no, line from lines where regexp_full_match(upper({s_('line')}), '{ROMAN}') and contains('MDCLXVI', substr(upper({s_('line')}), 1, 1)) and {s_('line')} <> ''")
def roman_lines(spark, sf_dir):
    return book_lines(spark, sf_dir).where(T.is_roman(F.col("line")))


@query(f"with {LINES} select book_id, line_no, cast(length(line) - length(translate(line, '.-', '')) as bigint) as n from lines")
def dot_dash(spark, sf_dir):
    return book_lines(spark, sf_dir).select("book_id", "line_no", L.dot_dash(F.col("line")).alias("n"))


@query(f'with {LINES}, {CLASSES} select book_id, line_no, line, length, class, "check" from checked')
def classify_lines(spark, sf_dir):
    return L.classify_lines(book_lines(spark, sf_dir), ["book_id"])


@query(f"with {LINES}, {CLASSES} select class, count(*) as n from checked group by class")
def line_classes(spark, sf_dir):
    return classify_lines(spark, sf_dir).groupBy("class").agg(F.count("*").alias("n"))


@query(f"with {LINES}, {CLASSES}, {KEPT} select book_id, line_no, line, class from kept")
def filter_unwanted(spark, sf_dir):
    return L.filter_unwanted(classify_lines(spark, sf_dir)).select("book_id", "line_no", "line", "class")


@query(f"with {LINES}, {CLASSES}, {KEPT}, {GLUED} select * from glued")
def paragraph_concat(spark, sf_dir):
    return L.concat_paragraphs(L.filter_unwanted(classify_lines(spark, sf_dir)), ["book_id"])


@query(f"with {LINES}, {TIDY.replace('SOURCE', 'lines')} select * from tidy")
def ws_cleanup(spark, sf_dir):
    return L.drop_blank(book_lines(spark, sf_dir))


@query(f"with {LINES}, {BULLETED.replace('SOURCE', 'lines')} select * from merged")
def bullet_merge(spark, sf_dir):
    return L.merge_bullets(book_lines(spark, sf_dir), ["book_id"])


CLEAN = f"{LINES}, {CLASSES}, {KEPT}, {GLUED}, {TIDY.replace('SOURCE', 'glued')}, {BULLETED.replace('SOURCE', 'tidy')}"


@query(f"with {CLEAN} select * from merged")
def clean_lines(spark, sf_dir):
    return L.clean_lines(book_lines(spark, sf_dir), ["book_id"])


@query(f"with {LINES} select book_id, line_no, line from lines qualify row_number() over (partition by book_id order by line_no) > 3")
def front_matter(spark, sf_dir):
    return L.skip_front(book_lines(spark, sf_dir), ["book_id"], 3)


# ---- corpus

TAG = "case when contains(line, '_START_SECTION_') then 'section' when contains(line, '_START_ARTICLE_') then 'article' end"
SELECTED = f"""sel as (select *, {TAG} as tag, {TAG} is not null and {u_('tags', 'doc_id', 'line_no')} < 0.7 as selected from lines)"""
SECTIONS = """sk as (select *, coalesce(last_value(case when selected then 1 when contains(line, '_START_PARAGRAPH_') then 0 end ignore nulls) over (partition by doc_id order by line_no rows between unbounded preceding and current row), 0) as skip from sel),
rest as (select doc_id, line_no, line from sk where skip = 0 or contains(line, '_START_PARAGRAPH_'))"""


@query(f"with {TAGGED}, {SELECTED} select doc_id, line_no, line, tag, selected from sel")
def tag_select(spark, sf_dir):
    return E.select_tags(tagged_lines(spark, sf_dir), "doc_id")


@query(f"with {TAGGED}, {SELECTED}, {SECTIONS} select doc_id, line_no, line from rest")
def section_removal(spark, sf_dir):
    return E.remove_sections(tagged_lines(spark, sf_dir), "doc_id")


@query(f"with {TAGGED}, {SELECTED}, {SECTIONS} select doc_id, substr(string_agg(line, chr(10) order by line_no), 2) as text from rest group by doc_id")
def reassemble(spark, sf_dir):
    return E.reassemble(E.remove_sections(tagged_lines(spark, sf_dir), "doc_id"), "doc_id")


@query("select lang, doc_id, cast(coalesce(sum(length(text) + 1) over (partition by lang order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as start, cast(length(text) + 1 as bigint) as chars, md5(text || chr(10)) as digest from documents where text is not null")
def corpus_concat(spark, sf_dir):
    """Where each document's text stands in the one text of its language."""
    rows = documents(spark, sf_dir).where("text is not null").select("lang", "doc_id", (F.length("text") + 1).cast("long").alias("chars"), F.md5(F.concat("text", F.lit("\n"))).alias("digest"))
    return E.offsets(rows, "lang", "doc_id", F.col("chars"))


CHUNKS = "ch0 as (select doc_id, text, length(text) as len, case when 4 > length(text) then greatest(1, length(text) // 100) else 4 end as n from documents), ch1 as (select *, unnest(range(0, n)) as chunk from ch0), chunks as (select doc_id, cast(chunk as bigint) as chunk, substr(text, cast(chunk * len // n + 1 as bigint), cast((chunk + 1) * len // n - chunk * len // n as bigint)) as chunk_text from ch1)"


@query(f"with {CHUNKS} select * from chunks")
def corpus_chunks(spark, sf_dir):
    return E.split_at_characters(documents(spark, sf_dir), "doc_id", 4)


def pack_sql(source: str, text: str, keys: str) -> str:
    ws = f"list_filter(regexp_split_to_array({text}, '[{WS}]+'), lambda x: x <> '')"
    return f"""w as (select {keys}, {ws} as ws, list_transform({ws}, lambda x: greatest(1, cast(ceil(length(x) / 4.0) as bigint))) as ns from {source}),
f as (select {keys}, ws, list_reduce(list_prepend({{'g': [0::bigint], 'c': 0::bigint}}, list_transform(ns, lambda n: {{'g': [n], 'c': 0::bigint}})), lambda a, x: {{'g': list_append(a.g, case when a.c + x.g[1] > 490 and len(a.g) > 1 then list_last(a.g) + 1 else list_last(a.g) end), 'c': case when a.c + x.g[1] > 490 then x.g[1] else a.c + x.g[1] end}}).g as g from w),
x as (select {keys}, unnest(range(1, len(ws) + 1)) as i, ws, g from f where len(ws) > 0),
samples as (select {keys}, seq, string_agg(word, ' ' order by i) as sample from (select {keys}, i, ws[i] as word, g[i + 1] as seq from x) group by {keys}, seq)"""


@query(f"with {pack_sql('documents', 'text', 'doc_id')} select doc_id, cast(seq as bigint) as seq, sample from samples")
def sample_pack(spark, sf_dir):
    return E.samples(documents(spark, sf_dir), ["doc_id"])


QUOTA = f"with {CHUNKS}, {pack_sql('chunks', 'chunk_text', 'doc_id, chunk')}"


@query(f"{QUOTA} select doc_id, chunk, cast(seq as bigint) as seq, sample from (select * from samples qualify row_number() over (partition by chunk order by doc_id, seq) <= 125) order by chunk, doc_id, seq limit 500")
def sample_quota(spark, sf_dir):
    chunks = E.split_at_characters(documents(spark, sf_dir), "doc_id", 4)
    return E.quota(E.samples(chunks, ["doc_id", "chunk"], "chunk_text"), "chunk", ["doc_id", "seq"], 500, 4)


@query(f"{QUOTA}, s as (select lang, samples.* from samples join documents using (doc_id)), q as (select * from s qualify row_number() over (partition by lang, chunk order by doc_id, seq) <= 34) select lang, doc_id, chunk, cast(seq as bigint) as seq, sample from q qualify row_number() over (partition by lang order by chunk, doc_id, seq) <= 133")
def split_samples(spark, sf_dir):
    """The quota of every split; languages stand for splits."""
    docs = documents(spark, sf_dir)
    chunks = E.split_at_characters(docs, "doc_id", 4).join(docs.select("doc_id", "lang"), "doc_id")
    return E.quota(E.samples(chunks, ["lang", "doc_id", "chunk"], "chunk_text"), "chunk", ["doc_id", "seq"], 133, 4, by=("lang",))


@query(r"select doc_id, regexp_replace(text, '(?s)\A(.*)\. .*\z', '\1.') as text from documents")
def drop_fragment(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", E.drop_fragment(F.col("text")).alias("text"))


UNMARKED = s_(f"regexp_replace(regexp_replace(line, '_[A-Z]+(_[A-Z]+)*_', ' ', 'g'), '[{WS}]+', ' ', 'g')")


@query(f"with {TAGGED} select doc_id, line_no, {UNMARKED} as line from lines")
def remove_markers(spark, sf_dir):
    return tagged_lines(spark, sf_dir).select("doc_id", "line_no", E.remove_markers(F.col("line")).alias("line"))


def noise_sql(kind: str, w: str, k: str) -> str:
    p = lambda place, n: f"cast(floor({dice_(place, *k.split(','))} * ({n})) as bigint)"
    n = f"length({w})"
    if kind == "special":
        return f"[{', '.join(f'chr({c})' for c in E.SPECIAL)}][{p(E.PLACE, len(E.SPECIAL))} + 1] || {w}"
    if kind == "remove":
        return f"case when {n} > 1 then substr({w}, 1, {p(E.PLACE, n)}) || substr({w}, {p(E.PLACE, n)} + 2) else {w} end"
    if kind == "add":
        i = p(E.PLACE, n + " + 1")
        return f"substr({w}, 1, {i}) || substr('abcdefghijklmnopqrstuvwxyz', {p(E.OTHER, 26)} + 1, 1) || substr({w}, {i} + 1)"
    i = p(E.PLACE, n)
    j = f"(({i} + 1 + {p(E.OTHER, n + ' - 1')}) % {n})"
    a, b = f"least({i}, {j})", f"greatest({i}, {j})"
    return f"case when {n} > 1 then substr({w}, 1, {a}) || substr({w}, {b} + 1, 1) || substr({w}, {a} + 2, {b} - {a} - 1) || substr({w}, {a} + 1, 1) || substr({w}, {b} + 2) else {w} end"


WORDS = f"words as (select doc_id, i - 1 as i, ws[i] as w from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from (select doc_id, list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '') as ws from documents)))"


def one_noise(kind: str):
    def f(spark, sf_dir):
        at = documents(spark, sf_dir).select("doc_id", F.posexplode(T.words(F.col("text"))).alias("i", "w"))
        return at.select("doc_id", F.col("i").cast("long").alias("i"), getattr(E, f"noise_{kind}")(F.col("w"), F.col("doc_id"), F.col("i")).alias("w"))
    f.__name__ = f"noise_{kind}"
    return f


for _kind in E.KINDS:
    query(f"with {WORDS} select doc_id, i, {noise_sql(_kind, 'w', 'doc_id,i')} as w from words")(one_noise(_kind))

KIND = f"[{', '.join(repr(k) for k in E.KINDS)}][cast(floor({dice_(E.KIND, 'doc_id', 'i')} * 4) as bigint) + 1]"
NOISY = f"""clean as (select doc_id, text, {s_(f"regexp_replace(regexp_replace(text, '_[A-Z]+(_[A-Z]+)*_', ' ', 'g'), '[{WS}]+', ' ', 'g')")} as t from documents),
words as (select doc_id, i - 1 as i, ws[i] as w from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from (select doc_id, list_filter(string_split(t, ' '), lambda x: x <> '') as ws from clean))),
noised as (select doc_id, i, case when {dice_(E.APPLY, 'doc_id', 'i')} >= 0.1 then w when {KIND} = 'remove' then {noise_sql('remove', 'w', 'doc_id,i')} when {KIND} = 'add' then {noise_sql('add', 'w', 'doc_id,i')} when {KIND} = 'swap' then {noise_sql('swap', 'w', 'doc_id,i')} else {noise_sql('special', 'w', 'doc_id,i')} end as w from words),
pairs as (select c.doc_id, coalesce(string_agg(w, ' ' order by i), '') as text, any_value(c.text) as target from clean c left join noised n on c.doc_id = n.doc_id group by c.doc_id)"""


@query(f"with {NOISY} select * from pairs")
def noise_pairs(spark, sf_dir):
    return E.noise_pairs(documents(spark, sf_dir), "doc_id", "text")


@query(f"with {NOISY} select doc_id, '{E.PROMPT}' as \"Prompt\", coalesce(text, '') as \"Train\", coalesce(target, '') as \"Target\" from pairs")
def prompt_rows(spark, sf_dir):
    return E.prompt_rows(noise_pairs(spark, sf_dir), "doc_id")


@query(f"with {WORDS} select doc_id, count(*) as words, cast(sum(greatest(1, cast(ceil(length(w) / 4.0) as bigint))) as bigint) as tokens from words group by doc_id")
def token_lengths(spark, sf_dir):
    at = documents(spark, sf_dir).select("doc_id", F.explode(T.words(F.col("text"))).alias("w"))
    return at.groupBy("doc_id").agg(F.count("*").alias("words"), F.sum(T.token_length(F.col("w"))).cast("long").alias("tokens"))


# ---- training

@query("select doc_id, source from documents order by md5('42:' || doc_id), doc_id limit 100")
def shuffle_head(spark, sf_dir):
    return R.shuffle_head(documents(spark, sf_dir).select("doc_id", "source"), "doc_id", 100)


TURNS = "turns as (select conv_id, turn, text as \"Train\", lead(text) over (partition by conv_id order by turn) as \"Target\" from conversations)"
CHAT = f"chat as (select conv_id, turn, '<|system|>' || chr(10) || '{E.PROMPT}' || '<|endoftext|><|user|>' || chr(10) || coalesce(\"Train\", '') || '<|endoftext|><|assistant|>' || chr(10) || coalesce(\"Target\", '') as text from turns)"


def turns(spark, sf_dir):
    from pyspark.sql import Window

    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.lit(E.PROMPT).alias("Prompt"), F.col("text").alias("Train"), F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")).alias("Target"))


@query(f"with {TURNS}, {CHAT} select * from chat")
def chat_template(spark, sf_dir):
    return R.training_rows(turns(spark, sf_dir), "conv_id", "turn")


@query(f"with {TURNS}, {CHAT} select conv_id, turn, string_split(text, '<|assistant|>')[1] || '<|assistant|>' || chr(10) as prompt, {s_(chr(34) + 'p' + chr(34))} as expected from (select *, string_split(text, '<|assistant|>')[2] as p from chat)")
def template_parse(spark, sf_dir):
    return R.parse_template(chat_template(spark, sf_dir)).select("conv_id", "turn", "prompt", "expected")


@query(f"with {TURNS}, {CHAT} select * from chat order by conv_id, turn limit 2")
def probe_rows(spark, sf_dir):
    return chat_template(spark, sf_dir).orderBy("conv_id", "turn").limit(2)


@query("select doc_id from documents where doc_id > 0 and doc_id % 50 = 0")
def every_n(spark, sf_dir):
    return documents(spark, sf_dir).where(R.every(F.col("doc_id"), 50)).select("doc_id")


@query("select arg_max('out/checkpoint-' || doc_id, doc_id) as path from documents")
def latest_checkpoint(spark, sf_dir):
    return R.latest_checkpoint(documents(spark, sf_dir).select(F.concat(F.lit("out/checkpoint-"), "doc_id").alias("path")))


# ---- correction

LEN = f"1 + list_sum(list_prepend(0, list_transform(list_filter(regexp_split_to_array(line, '[{WS}]+'), lambda x: x <> ''), lambda x: greatest(1, cast(ceil(length(x) / 4.0) as bigint)))))"
BATCHES = f"""bl as (select book_id, row_number() over (partition by book_id order by line_no) as i, line, cast({LEN} as bigint) as n from lines where line <> ''),
ar as (select book_id, list(n order by i) as ns, list(line order by i) as ls from bl group by book_id),
fo as (select book_id, ls, list_reduce(list_prepend({{'g': [0::bigint], 'c': 0::bigint, 'open': 0::bigint}}, list_transform(ns, lambda n: {{'g': [n], 'c': 0::bigint, 'open': 0::bigint}})), lambda a, x:
 case when a.c + x.g[1] > 200 and a.open > 0 and x.g[1] > 200 then {{'g': list_append(a.g, list_last(a.g) + 1), 'c': 0::bigint, 'open': 0::bigint}}
 when a.c + x.g[1] > 200 and a.open > 0 then {{'g': list_append(a.g, list_last(a.g) + 1), 'c': x.g[1], 'open': 1::bigint}}
 when a.open = 0 then {{'g': list_append(a.g, list_last(a.g) + 1), 'c': x.g[1], 'open': 1::bigint}}
 else {{'g': list_append(a.g, list_last(a.g)), 'c': a.c + x.g[1], 'open': 1::bigint}} end).g as g from ar),
un as (select book_id, ls, g, unnest(range(1, len(ls) + 1)) as i from fo),
batches as (select book_id, cast(b - 1 as bigint) as batch_index, string_agg(l || chr(10), '' order by i) as original_batch from (select book_id, i, ls[i] as l, g[i + 1] as b from un) group by book_id, b)"""


@query(f"with {LINES}, {BATCHES} select * from batches")
def line_batches(spark, sf_dir):
    return G.pack_lines(book_lines(spark, sf_dir), ["book_id"], 200)


@query(f"with {LINES}, {BATCHES} select book_id, batch_index, '{G.PROMPT[0]}'.replace('\\n', chr(10)) || original_batch || '{G.PROMPT[1]}'.replace('\\n', chr(10)) as prompt, batch_index % 3 as instance from batches".replace("'" + G.PROMPT[0] + "'.replace('\\n', chr(10))", "'" + G.PROMPT[0] + "'").replace("'" + G.PROMPT[1] + "'.replace('\\n', chr(10))", "'" + G.PROMPT[1] + "'"))
def batch_prompts(spark, sf_dir):
    return line_batches(spark, sf_dir).select("book_id", "batch_index", G.prompt(F.col("original_batch")).alias("prompt"), G.round_robin(F.col("batch_index"), 3).alias("instance"))


def norm_sql(x: str, markers=T.TAGS) -> str:
    for m in markers:
        x = f"replace({x}, '{m}', ' ')"
    x = rf"regexp_replace(replace(replace({x}, '- ', '-'), '…', '...'), '\.([A-Z])', '. \1', 'g')"
    return s_(f"regexp_replace({x}, '[{WS}]+', ' ', 'g')")


@query(f"with {TAGGED} select doc_id, line_no, {norm_sql('line')} as result, {norm_sql('line', ())} as original from lines")
def compare_normalise(spark, sf_dir):
    return tagged_lines(spark, sf_dir).select("doc_id", "line_no", G.normalise(F.col("line")).alias("result"), G.normalise(F.col("line"), ()).alias("original"))


def edited(spark, sf_dir):
    """Pairs of a text and itself with every 37th word changed."""
    w = F.transform(T.words(F.col("text")), lambda x, i: F.when(F.pmod(i + F.col("doc_id"), F.lit(37)) == 36, F.concat(x, F.lit("x"))).otherwise(x))
    return documents(spark, sf_dir).select("doc_id", "text", F.array_join(w, " ").alias("other"))


@query()
def fuzzy_prefix(spark, sf_dir):
    return G.prefix_score(edited(spark, sf_dir), ["doc_id"], "text", "other")


@query(f"""with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[{WS}]+'), lambda x: x <> '') as ws from documents),
x as (select doc_id, unnest(range(1, len(ws) + 1)) as i, ws from w),
s as (select doc_id, min(case when (i - 1 + doc_id) % 37 = 36 then i end) as stop from x group by doc_id),
m as (select x.doc_id, count(*) filter (stop is null or i < stop) as c, sum(length(ws[i])) filter (stop is null or i < stop) as n, max(stop) as stop from x join s using (doc_id) group by x.doc_id)
select w.doc_id, cast(coalesce(c, 0) as bigint) as match_count, cast(coalesce(n, 0) as bigint) as matched_chars, cast(case when c is null then 0 when stop is null then 100 else 0 end as integer) as last_match_ratio from w left join m using (doc_id)""")
def exact_prefix(spark, sf_dir):
    return G.prefix_score(edited(spark, sf_dir), ["doc_id"], "text", "other", fuzzy=False)


@query("with e as (select label, unnest(range(1, 65)) as i, embedding from embeddings) select label, cast(i - 1 as bigint) as dim, round(avg(cast(embedding[i] as double)), 6) as mean from e group by label, i")
def mean_pool(spark, sf_dir):
    out = G.mean_pool(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return out.select("label", F.posexplode("embedding").alias("dim", "mean")).select("label", F.col("dim").cast("long").alias("dim"), F.round("mean", 6).alias("mean"))


@query("with p as (select a.vec_id, a.embedding as x, b.embedding as y from embeddings a join embeddings b on b.vec_id = a.vec_id + 1) select vec_id, round(list_cosine_similarity(x::double[], y::double[]), 6) as similarity from p")
def cosine_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    pairs = e.select("vec_id", F.col("embedding").alias("x")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y")), "vec_id")
    return pairs.select("vec_id", F.round(G.cosine(F.col("x"), F.col("y")), 6).alias("similarity"))


STUB = "done as (select book_id, batch_index, original_batch, case when batch_index % 7 = 3 or (book_id + batch_index) % 11 = 5 then null else replace(original_batch, 'e', 'E') end as processed_result, case when (book_id + batch_index) % 11 = 5 then 'stub' end as error from batches), results as (select *, case when error is not null then 'future_error' when processed_result is null then 'processing_failed' else 'success' end as status from done)"


def stub_model():
    """A corrector for tests: fails on prompts of some lengths, else writes e as E."""
    begin, end = G.PROMPT
    return lambda prompts: [None if len(p) % 7 == 3 else p[len(begin) : len(p) - len(end)].replace("e", "E") for p in prompts]


@query(f"with {LINES}, {BATCHES}, c as (select book_id, batch_index, original_batch, case when length('{G.PROMPT[0]}' || original_batch || '{G.PROMPT[1]}') % 7 <> 3 then replace(original_batch, 'e', 'E') end as processed_result from batches) select *, case when processed_result is null then 'processing_failed' else 'success' end as status, cast(null as varchar) as error from c")
def corrected_batches(spark, sf_dir):
    return G.result_records(G.correct(line_batches(spark, sf_dir), stub_model), "book_id")


def stub_results(spark, sf_dir):
    """The corrector is an expression here, so that SQL can follow."""
    late = F.pmod(F.col("book_id") + F.col("batch_index"), F.lit(11)) == 5
    done = line_batches(spark, sf_dir).withColumn("processed_result", F.when(~late & (F.pmod("batch_index", F.lit(7)) != 3), F.replace("original_batch", F.lit("e"), F.lit("E")))).withColumn("error", F.when(late, "stub"))
    return G.result_records(done, "book_id")


VOWELS = "aeiouE"


def vowels(text):
    """A stand-in for an embedding: how often each of some letters occurs."""
    return F.array(*((F.length(text) - F.length(F.replace(text, F.lit(v), F.lit("")))).cast("double") for v in VOWELS))


def vowels_sql(x: str) -> str:
    return f"[{', '.join(f'(length({x}) - length(replace({x}, {v!r}, {chr(39) * 2})))::double' for v in VOWELS)}]"


COMPARED = f"""nt as (select *, {norm_sql('original_batch', ())} as x, {norm_sql('processed_result')} as y from results),
ct as (select *, list_filter(regexp_split_to_array(x, '[{WS}]+'), lambda w: w <> '') as xs, list_filter(regexp_split_to_array(coalesce(y, ''), '[{WS}]+'), lambda w: w <> '') as ys, {vowels_sql('x')} as xv, {vowels_sql("coalesce(y, '')")} as yv from nt),
st as (select *, least(len(xs), len(ys)) as n, list_position(list_transform(range(1, least(len(xs), len(ys)) + 1), lambda i: lower(xs[i]) = lower(ys[i])), false) as stop from ct),
mt as (select *, case when coalesce(stop, 0) = 0 then n else stop - 1 end as m from st)"""
FIELDS = "case when y is not null then cast(m as bigint) end as match_count, case when y is not null then cast(length(array_to_string(xs[1:m], '')) as bigint) end as matched_chars, case when y is not null then cast(case when n = 0 or coalesce(stop, 0) > 0 then 0 else 100 end as integer) end as last_match_ratio, case when y is not null then round(case when list_sum(xv) = 0 or list_sum(yv) = 0 then 0.0 else list_cosine_similarity(xv, yv) end, 6) end as cosine_similarity"


def compared(results):
    """Result records with their comparison, its fields side by side."""
    score = F.col("comparison.fuzzy_match_score")
    return results.select("book_id", "batch_index", "original_batch", "processed_result", *(score[c].alias(c) for c in ("match_count", "matched_chars", "last_match_ratio")), F.round("comparison.cosine_similarity", 6).alias("cosine_similarity"), "status", "error")


@query(f"with {LINES}, {BATCHES}, {STUB}, {COMPARED} select book_id, batch_index, original_batch, processed_result, {FIELDS}, status, error from mt")
def result_records(spark, sf_dir):
    return compared(G.compare(stub_results(spark, sf_dir), vowels, fuzzy=False))


@query(f"with {LINES}, {BATCHES}, {STUB} select book_id, count(*) filter (status = 'success') as succeeded, count(*) filter (status <> 'success') as failed from results group by book_id")
def outcome_counts(spark, sf_dir):
    return G.outcome_counts(stub_results(spark, sf_dir), "book_id")


@query(f"with {LINES}, {BATCHES}, {STUB} select book_id, batch_index, processed_result from results where status = 'success' and (batch_index is null or batch_index not in (0, 2, 3))")
def filter_results(spark, sf_dir):
    return H.filter_results(stub_results(spark, sf_dir), [0, 2, 3]).select("book_id", "batch_index", "processed_result")


@query(f"with {LINES}, {BATCHES}, {STUB} select count(*) filter (status <> 'success' or batch_index in (0, 2, 3)) as removed from results")
def removed_count(spark, sf_dir):
    at = stub_results(spark, sf_dir)
    return H.removed_count(at, H.filter_results(at, [0, 2, 3]))


@query(f"with {LINES}, {BATCHES}, {STUB} select book_id, string_agg(processed_result, chr(10) || chr(10) order by batch_index) as text from results where status = 'success' and length(processed_result) > 0 group by book_id")
def results_text(spark, sf_dir):
    return H.joined(stub_results(spark, sf_dir).where("status = 'success'"), ["book_id"], "batch_index", "processed_result").select("book_id", F.col("processed_result").alias("text"))


@query("select conv_id as book_id, md5(coalesce(string_agg(text || chr(10) || chr(10), '' order by turn) filter (length(text) > 0), '')) as digest from conversations group by conv_id")
def page_text(spark, sf_dir):
    out = H.joined(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", end=True)
    return out.select(F.col("conv_id").alias("book_id"), F.md5("text").alias("digest"))


# ---- speech

BOOKS = f"{LINES}, books as (select book_id, string_agg(line, chr(10) order by line_no) as text from lines group by book_id)"
NUMBERS = rf"(?m)^[{WS}]*\p{{Nd}}+[{WS}]*$|^[{WS}]*\p{{Nd}}+[{WS}]+[^\n]*$|^[^\n]*[{WS}]+\p{{Nd}}+[{WS}]*$"


def books(spark, sf_dir):
    return L.concat_pages(book_lines(spark, sf_dir).select("book_id", F.col("line_no").alias("page_no"), F.col("line").alias("text")), ["book_id"])


@query("with %s select book_id, %s as text from books" % (BOOKS, s_(rf"regexp_replace(regexp_replace(text, '{NUMBERS}', '', 'g'), '\n[{WS}]*\n', chr(10), 'g')")))
def page_numbers(spark, sf_dir):
    return books(spark, sf_dir).select("book_id", I.remove_page_numbers(F.col("text")).alias("text"))


REJOIN = r"regexp_replace(regexp_replace(text, '([a-z])\n\n+([a-z])', '\1 \2', 'g'), '([a-z])\n\n+([a-z])', '\1 \2', 'g')"
PARAS = rf"""pp as (select book_id, regexp_split_to_array({REJOIN}, '\n\n+') as ps from books),
pq as (select book_id, ps, unnest(range(1, len(ps) + 1)) as i from pp),
pl as (select book_id, i, string_split(ps[i], chr(10)) as ls from pq),
pu as (select book_id, i, k, ls[k] as l, case when k > 1 and (regexp_matches(ls[k - 1], '[.!?]$') or regexp_matches(ls[k], '^[A-Z]')) then chr(10) when k > 1 then ' ' else '' end as sep from (select book_id, i, ls, unnest(range(1, len(ls) + 1)) as k from pl)),
pj as (select book_id, i, {s_("string_agg(sep || l, '' order by k)")} as paragraph from pu group by book_id, i),
paras as (select book_id, cast(row_number() over (partition by book_id order by i) - 1 as bigint) as para_no, paragraph from pj where paragraph <> '')"""


@query(f"with {BOOKS}, {PARAS} select * from paras")
def paragraphs(spark, sf_dir):
    return I.paragraphs(books(spark, sf_dir), ["book_id"])


@query(f"""with {BOOKS}, {PARAS}, ca as (select *, count(*) over (partition by book_id) as n from paras), cb as (select *, ceil(n / cast(least(3, n) as double)) as size from ca),
cc as (select book_id, para_no, paragraph, cast(floor(para_no / size) as bigint) as proc, cast(para_no - floor(para_no / size) * size as bigint) as part from cb)
select *, proc % 3 as gpu, 'data/output_part_proc' || proc || '_part_' || (proc % 3) || '_' || part || '.wav' as path from cc""")
def chunk_schedule(spark, sf_dir):
    return I.schedule(paragraphs(spark, sf_dir), ["book_id"], 3)


@query(f"""with {BOOKS}, {PARAS}, ca as (select *, count(*) over (partition by book_id) as n from paras), cb as (select *, ceil(n / cast(least(3, n) as double)) as size from ca),
cc as (select book_id, para_no, cast(floor(para_no / size) as bigint) as proc, cast(para_no - floor(para_no / size) * size as bigint) as part from cb),
cd as (select book_id, para_no, proc, part, 'data/output_part_proc' || proc || '_part_' || (proc % 3) || '_' || part || '.wav' as path from cc)
select book_id, path, row_number() over (partition by book_id order by proc, part) as by_number, row_number() over (partition by book_id order by path) as by_name from cd""")
def part_order(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("book_id")
    out = chunk_schedule(spark, sf_dir)
    return out.select("book_id", "path", *(F.row_number().over(w.orderBy(*I.part_order(by_name=k))).cast("long").alias(n) for n, k in (("by_number", False), ("by_name", True))))
