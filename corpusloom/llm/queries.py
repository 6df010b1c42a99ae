"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from corpusloom.llm import bpe, chat, exact, language, licenses, neighbours, orchard, packing, recompression, repair, simhash, tokenfile, toxicity
from corpusloom.llm.base import table, written

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_language_id(spark, d):
    docs = table(spark, d, "documents")
    found = language.predicted(docs, language.fitted(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_token_ids(spark, d):
    manifest = tokenfile.write_ids(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"), "byte")
    return tokenfile.with_checksums(tokenfile.read_ids(manifest))


@query
def op6_best_fit_packing(spark, d):
    return packing.packed(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), "word")


@query
def op7_simhash(spark, d):
    found = simhash.simhash_groups(table(spark, d, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_exact_dedup(spark, d):
    return exact.exact_groups(table(spark, d, "documents")).drop("n_chars")


ORACLE["op8_exact_dedup"] = r"""
with n as (select doc_id, length(coalesce(text,'')) n_chars,
                  sha256(regexp_replace(coalesce(text,''),'[\x20\x09-\x0D]','','g')) text_sha256
           from documents)
select doc_id, first_value(doc_id) over w keep_id, count(*) over (partition by text_sha256) group_size,
       row_number() over w = 1 kept, text_sha256
from n window w as (partition by text_sha256 order by n_chars desc, doc_id)"""


@query
def op10_toxicity(spark, d):
    docs = table(spark, d, "documents")
    found = toxicity.scored(docs, toxicity.fitted(docs, table(spark, d, "labels")))
    return found.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query
def op9_byte_bpe(spark, d):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.round_trip(table(spark, d, "documents"), path, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op1_hnsw(spark, d):
    vectors = table(spark, d, "embeddings")
    index = written(neighbours.build(vectors), "graphs")
    return neighbours.search(index, vectors.where("vec_id % 50 = 0"), 5)


def _conversations(spark, d):
    """All conversations and one whose texts hold the template's own marks."""
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    return table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)


@query
def op3_chat_windows(spark, d):
    return chat.read_back(chat.windows(_conversations(spark, d)))


ORACLE["op3_chat_windows"] = r"""
with r as (select conv_id, turn, coalesce(role,'') as role, coalesce(text,'') as text from conversations
           union all select -7, 0, 'user', '\### Assistant: </turn> ok'
           union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (select conv_id, role, text, row_number() over o n, k, sum(k) over o upto
      from (select *, 4+len(regexp_extract_all(text,'[0-9A-Za-z_]+|[^0-9A-Za-z_\x20\x09-\x0D]')) k from r)
      window o as (partition by conv_id order by turn nulls first, role, text rows unbounded preceding)),
k as (select *, upto-k before, (upto-k)//512 stretch, upto > ((upto-k)//512+1)*512 alone,
             8+length(role)+length(text)+9+length(text)-length(replace(replace(text,'\',''),'<',''))
             +length(role)-length(replace(replace(replace(replace(role,'\',''),'<',''),'>',''),chr(10),'')) size from t),
w as (select conv_id, stretch, alone, min(n) f, min(before) b from k group by all),
s as (select conv_id, min(n) n from k where role='system' group by conv_id),
again as (select w.conv_id, k.size from w join k on k.conv_id=w.conv_id and k.n<w.f
            where k.before>=w.b-128 or k.n=(select s.n from s where s.conv_id=w.conv_id)),
c as (select conv_id, sum(size) chars from (select conv_id, size from k union all select * from again) group by 1)
select conv_id, count(*) n_turns, sha256(string_agg(role||chr(10)||text||chr(10),'' order by n)) turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role='assistant'),0) as bigint) loss_chars,
       sha256(coalesce(string_agg(text,'' order by n) filter (where role='assistant'),'')) loss_sha256,
       cast(any_value(chars) as bigint) formatted_chars
from t join c using (conv_id) group by conv_id"""


@query
def op4_license_scan(spark, d):
    docs = table(spark, d, "documents")
    return licenses.found(docs, licenses.fitted(docs))


@query
def op11_orchard_clusters(spark, d):
    return orchard.with_inertia(*orchard.clustered(table(spark, d, "embeddings"), 40, 5))


def _clusters_sql(k: int, rounds: int) -> str:
    """One common table for each round's assignment and one for its centroids."""
    steps = [f"""
e as materialized (select row_number() over () rid, vec_id, embedding e from embeddings
  where len(embedding)=64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x)))=64),
v as materialized (select rid, vec_id, list_transform(e, lambda x: cast(floor(256*cast(x as double)) as bigint)) v from e),
c0 as materialized (select row_number() over (order by sha256('2:'||vec_id) nulls last, vec_id, v)-1 c, v w from v qualify c<{k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select rid, min({{'d': d, 'c': c}}) m from (select rid, c,
  cast(list_sum(list_transform(list_zip(v, w), lambda p: (p[1]-p[2])*(p[1]-p[2]))) as bigint) d from v, c{r}) group by rid)""")
        if r < rounds:
            steps.append(f"""
u{r} as (select c, i, sum(x) s, count(*) n from (select m.c c, unnest(v) x, generate_subscripts(v, 1) i from v join a{r} using (rid)) group by c, i),
c{r + 1} as materialized (select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) w from u{r} group by c
  union all select c, w from c{r} where c not in (select c from u{r}))""")
    return "with " + ",".join(steps) + f"""
select vec_id, cast(m.c as int) as "cluster", m.d distance, cast(sum(m.d) over (partition by m.c) as bigint) cluster_inertia,
       cast(sum(m.d) over () as bigint) inertia, sha256(array_to_string(w, ',')) centroid_sha256
from v join a{rounds} using (rid) join c{rounds} on c{rounds}.c = m.c"""


ORACLE["op11_orchard_clusters"] = _clusters_sql(40, 5)


def damaged(conversations):
    """The rows of the contract: some dropped, emptied, stripped of their ends, repeated or given to the user."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
    )
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("__way", F.crc32(name.cast("binary")) % 20).where("__way <> 0")
    way = F.col("__way")
    return rows.select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(way == 1, "").when(way == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


@query
def op13_repaired_conversations(spark, d):
    conversations = table(spark, d, "conversations")
    found = repair.summary(repair.edits(damaged(conversations)))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A step takes one row; up to two rows may be inserted before it.
ORACLE["op13_repaired_conversations"] = r"""
with recursive
r as (select coalesce(conv_id::varchar,' ') ck, conv_id, turn, coalesce(role,' ') as role, coalesce(text,' ') as text,
             xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(  -- crc32, a bit at a time
               string_split(coalesce(conv_id::varchar,' ')||':'||coalesce(turn::varchar,' '), ''), lambda k: [ord(k)::bigint,0,0,0,0,0,0,0]))),
               lambda a, b: xor(xor(a,b)>>1, case when xor(a,b)%2=1 then 3988292384 else 0 end)), 4294967295) % 20 way from conversations),
d as (select ck, turn, case when way=4 then 'user' else role end as role,
             case way when 1 then '' when 2 then regexp_replace(text,'[.!?]','','g') else text end as text
      from r, (values (0),(1)) x(copy) where way<>0 and (copy=0 or way=3)),
n as (select *, row_number() over w i, left(role,1) c, rtrim(text, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) body
      from d window w as (partition by ck order by turn nulls first, role, md5(length(role)||':'||role||text))),
f as materialized (select *, case when body='' then 'blank' when row_number() over (partition by ck, role, text order by i)>1 then 'duplicate'
             when right(body,1) not in ('.','!','?') then 'truncated' else '' end fault from n),
insertion(s, t, cost, e) as (values (0,0,0,''),(1,1,0,''),(2,2,0,''),(3,3,0,''),(0,2,5,'I'),(1,2,5,'I'),(3,2,5,'I'),
             (2,3,5,'I'),(0,3,10,'II'),(1,3,10,'II')),
p(ck, i, s, best) as (select ck, 0::bigint, 0, {'cost': 0, 'audit': ''} from (select distinct ck from f)
  union all
  select ck, i, t, min({'cost': cost, 'audit': audit}) from (
    select p.ck ck, f.i i, o.t t, p.best.cost + x.cost + o.cost cost, p.best.audit || x.e || o.e audit
    from p join insertion x on x.s=p.s join f on f.ck=p.ck and f.i=p.i+1,
    lateral (select x.t, 2, 'D'
             union all select case when x.t=2 then 3 else 2 end, 1+case when fault='truncated' then 5 else 0 end, 'R' where fault in ('','truncated')
             union all select case c when 's' then 1 when 'u' then 2 else 3 end, case when fault='truncated' then 5 else 0 end, 'K'
             where fault in ('','truncated') and ((c='s' and x.t=0) or (c='u' and x.t<>2) or (c='a' and x.t=2))) o(t, cost, e)
  ) group by ck, i, t),
z as (select ck, max(i) n from f group by ck),
b as (select p.ck ck, min({'cost': best.cost+x.cost, 'audit': best.audit||x.e}) best
      from p join z on z.ck=p.ck and z.n=p.i join insertion x on x.s=p.s where x.t in (0,3) group by p.ck),
l as (select ck, unnest(range(1, len(best.audit)+1)) pos, best.audit audit from b),
m as (select ck, pos, audit[pos] e, sum((audit[pos]<>'I')::int) over w i, sum((audit[pos]<>'D')::int) over w o from l window w as (partition by ck order by pos)),
j as (select m.ck, pos, e, o, f.role, f.text, f.c from m left join f on f.ck=m.ck and f.i=m.i and e<>'I'),
h as (select ck, bool_or(o=1 and e='K' and c='s') has from j group by ck),
k as (select j.ck, string_agg(case when e='K' then role when (o - has::int)%2=1 then 'user' else 'assistant' end || ':' ||
             case when e='I' then '' else text end, chr(10) order by pos) whole from j join h using (ck) where e<>'D' group by j.ck),
g as (select ck, coalesce(max(turn)-min(turn)+1-count(distinct turn),0) gaps, count(*) filter (where fault='blank') blank,
             count(*) filter (where fault='duplicate') duplicate, count(*) filter (where fault='truncated') truncated from f group by ck),
y as (select ck, count(*) filter (where was||c not in ('su','ua','au')) illegal from
      (select ck, c, lag(c) over (partition by ck order by i) was from f) group by ck)
select q.conv_id, coalesce(gaps,0) gaps, coalesce(blank,0) blank, coalesce(duplicate,0) duplicate, coalesce(truncated,0) truncated,
       coalesce(illegal,0) illegal, cast(coalesce(b.best.cost,0) as bigint) as cost, coalesce(b.best.audit,'') audit, sha256(coalesce(whole,'')) repaired_sha256
from (select distinct conv_id, ck from r) q left join g using (ck) left join y using (ck) left join b using (ck) left join k using (ck)"""


@query
def op12_repeated_passages(spark, d):
    found = recompression.without_repeats(table(spark, d, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op12_repeated_passages"] = r"""
with d as materialized (select row_number() over () rid, doc_id, regexp_extract_all(coalesce(text,''), '[^\x20\x09-\x0D]+') ws from documents),
w as materialized (select rid, i, array_to_string(ws[i:i+34], ' ') k from (select rid, ws, unnest(range(1, len(ws)-33)) i from d)),
c as materialized (select distinct rid, unnest(range(i, i+35)) pos from w where k in (select k from w group by k having count(*)>1)),
p as (select rid, unnest(ws) x, generate_subscripts(ws, 1) pos from d),
k as (select rid, string_agg(x, ' ' order by pos) whole from p anti join c using (rid, pos) group by rid),
n as (select rid, count(*) n from c group by rid)
select doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n,0) as bigint) n_removed, sha256(coalesce(whole,'')) kept_sha256
from d left join k using (rid) left join n using (rid)"""
