"""Queries over the driver's tables: each operator on a table that suits it, with the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import arrays, schedules, text
from sluice.operators import batches, bench, catalog, cuts, files, labels, monitor, resolve, split
from sluice.shared import fresh_path, saved
from sluice.sources import archives, paged, readers, tree, writers
from sluice.streaming import epochs, monitors, resumed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LIMITS = split.Limits()
LR = {"peak": 5e-5, "hold_ratio": 0.4}
TEMP = {"top": 1.0, "bottom": 0.5, "decay": 0.999}
BLOCKED = ("src3", "src7")
PREFIXES = {"asr": "click", "sid": "view", "er": "sign", "sd": "error", "asv": "purch"}

CLIPS = """clips as (select d.doc_id as row_index, d.source as channel_id, d.lang as language, d.n_chars * 20 as duration_ms, d.n_chars as size,
  md5(d.text) as filename, 'g' || (d.doc_id % 7)::varchar as genre, case when d.n_chars > 100 then 'clip ' || d.doc_id::varchar else '' end as title, 'c' || d.doc_id::varchar as id from documents d)"""
SEL = CLIPS + """, good as (select * from clips where duration_ms between 3000 and 900000 and channel_id not in ('src3', 'src7')),
channels as (select channel_id, count(*) as n, sum(duration_ms)::bigint as total_ms, arg_min(language, row_index) as language, md5('1337:' || channel_id) as o from good group by channel_id),
held as (select * from (select *, coalesce(sum(total_ms) over (order by o rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from channels) where ahead < 3600000)"""
CAP = SEL + """, rest as (select g.*, c.total_ms from good g join channels c using (channel_id) where channel_id not in (select channel_id from held)),
nth as (select row_index, channel_id, duration_ms, row_number() over (partition by channel_id order by md5('1337:' || row_index::varchar)) as i from rest where total_ms > 2160000),
fold as (select channel_id, i, row_index, duration_ms <= 2160000 as fits, case when duration_ms <= 2160000 then duration_ms else 0 end as used from nth where i = 1
  union all select n.channel_id, n.i, n.row_index, f.used + n.duration_ms <= 2160000, case when f.used + n.duration_ms <= 2160000 then f.used + n.duration_ms else f.used end
  from fold f join nth n on n.channel_id = f.channel_id and n.i = f.i + 1),
capped as (select * exclude (total_ms) from rest where total_ms <= 2160000 or row_index in (select row_index from fold where fits))"""
SPLIT = CAP + """, kept as (select k.channel_id, sum(k.duration_ms) as kept_ms, any_value(c.language) as language, any_value(c.o) as o from capped k join channels c using (channel_id) group by k.channel_id),
filled as (select *, coalesce(sum(kept_ms) over (partition by language order by o rows between unbounded preceding and 1 preceding), 0) as ahead from kept where language in ('en', 'fr', 'de')),
chosen as (select *, 'train' as split from capped where channel_id in (select channel_id from filled where ahead < case language when 'en' then 10000000 else 5000000 end)
  union all select *, 'holdout' from good where channel_id in (select channel_id from held))"""


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("row_index"), F.col("source").alias("channel_id"), F.col("lang").alias("language"), (F.col("n_chars") * 20).alias("duration_ms"), F.col("n_chars").alias("size"),
        F.md5("text").alias("filename"), F.concat(F.lit("g"), (F.col("doc_id") % 7).cast("string")).alias("genre"), F.when(F.col("n_chars") > 100, F.concat(F.lit("clip "), F.col("doc_id").cast("string"))).otherwise("").alias("title"), F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"),
    )


def blocked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in BLOCKED], "channel_id string")


def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split(clips(spark, sf_dir), blocked(spark), LIMITS)


def tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    raw = d.select(F.col("doc_id").cast("string").alias("source_id"), "lang", F.col("n_chars").cast("string").alias("size"), (F.col("n_chars") / 4096).cast("string").alias("duration_minutes"), F.when(F.col("quality") == 1, F.lit(" Yes")).when(F.col("quality") == 0, F.lit("no")).otherwise(F.lit("yes")).alias("to_train"))
    return catalog.union_tabs([catalog.tagged(raw.where(F.col("lang") == x), x, f"tab-{x}") for x in ("en", "fr", "de", "es")])


TABS = """tabs as (select d.doc_id::varchar as source_id, d.lang, d.n_chars::varchar as size, d.n_chars / 4096 as minutes, case l.quality when 1 then ' Yes' when 0 then 'no' else 'yes' end as to_train, d.lang as language, 'tab-' || d.lang as source_tab
  from documents d left join labels l using (doc_id) where d.lang in ('en', 'fr', 'de', 'es'))"""


@query(f"with {TABS} select source_id, lang, size, to_train, language, source_tab from tabs")
def catalog_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tabs(spark, sf_dir).drop("duration_minutes")


@query(f"with {TABS} select source_id::bigint as row_index, language, size::bigint as size_bytes, minutes * 60.0::double as duration_seconds, 'unknown' as genre from tabs where lower(trim(to_train)) = 'yes'")
def catalog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.load(tabs(spark, sf_dir), F.col("source_id").cast("long"), defaults={"genre": "unknown"})
    return rows.select("row_index", "language", "size_bytes", "duration_seconds", "genre")


@query(f"with {TABS} select coalesce(language, 'all') as language, count(*) as total, count(*) filter (lower(to_train) = 'yes') as to_train from tabs group by rollup (language)")
def catalog_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.metadata(tabs(spark, sf_dir), "language", "to_train").withColumn("language", F.coalesce("language", F.lit("all")))


URL_LANG = "regexp_extract_all(lower(url), 'en|fr|de|es')[-1]"


@query(f"select lang as own_language, count(*) as n from documents join (select page_id, {URL_LANG} as derived from pages) on doc_id = page_id where lang <> coalesce(derived, '') group by lang")
def catalog_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "pages"), F.col("doc_id") == F.col("page_id"))
    return catalog.contradictions(rows, "lang", text.last_language(F.col("url"), ["en", "fr", "de", "es"]))


@query(f"select page_id, {URL_LANG} as language from pages")
def lang_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.last_language(F.col("url"), ["en", "fr", "de", "es"]).alias("language"))


@query("select page_id, regexp_replace(name, '(.)\\.[^.]*$', '\\1') || '-' || substr(sha1(url), 1, 10) as clip_id from (select page_id, url, split_part(url, '/', -1) as name from pages)")
def clip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.clip_id(F.col("url")).alias("clip_id"))


@query(f"with {CLIPS} select row_index, language, channel_id, filename, size from (select *, row_number() over (partition by lower(language), channel_id, filename, size order by row_index) as n from clips) where n = 1")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [F.lower("language"), F.col("channel_id"), F.col("filename"), F.col("size")]
    return resolve.first_of_each(clips(spark, sf_dir), keys, "row_index").select("row_index", "language", "channel_id", "filename", "size")


# copies have one genre and file name here, so that keys repeat; some paths lack a folder and so don't count
RESOLVED = """wanted as (select doc_id as row_index, lang as language, 'g' || substr(md5(text), 1, 1) as genre, md5(text) as filename, n_chars as size from documents),
look as (select lower(w.language) as k_language, w.genre, w.filename, w.size, count(*) as n, min(upper(w.language) || '/' || w.genre || '/d' || w.row_index::varchar || '/' || w.filename) as path
  from wanted w join labels l on l.doc_id = w.row_index where w.size % 11 <> 0 group by 1, 2, 3, 4),
joined as (select w.row_index, l.n, l.path, row_number() over (partition by case when l.n = 1 then l.path end, case when l.n is distinct from 1 then w.row_index end order by w.row_index) as nth
  from wanted w left join look l on w.language = l.k_language and w.genre = l.genre and w.filename = l.filename and w.size = l.size),
resolved as (select row_index, case when n is null then 'no_match' when n > 1 then 'ambiguous' when nth > 1 then 'duplicate_path' else 'resolved' end as status, path from joined)"""


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    name = F.md5("text")
    wanted = d.select(F.col("doc_id").alias("row_index"), F.col("lang").alias("language"), F.concat(F.lit("g"), F.substring(name, 1, 1)).alias("genre"), name.alias("filename"), F.col("n_chars").alias("size"))
    folder = F.when(F.col("size") % 11 != 0, F.concat(F.lit("d"), F.col("row_index").cast("string")))  # null: left out of the path
    there = wanted.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_index")), "row_index")
    look = resolve.path_lookup(there.select(F.concat_ws("/", F.upper("language"), "genre", folder, "filename").alias("relpath"), "size"))
    on = (F.col("language") == F.col("k_language")) & (F.col("genre") == F.col("k_genre")) & (F.col("filename") == F.col("k_filename")) & (F.col("size") == F.col("k_size"))
    return resolve.resolve(wanted, look, on, "row_index")


@query(f"with {RESOLVED} select row_index, status, case when status = 'resolved' then path end as path from resolved")
def resolve_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).select("row_index", "status", "path")


@query(f"with {RESOLVED} select " + ", ".join(f"count(*) filter (status = '{r}') as {r}" for r in (*resolve.REASONS, "resolved")) + " from resolved")
def resolve_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.summary(resolved(spark, sf_dir))


@query(f"with {SEL} select row_index, channel_id, language, duration_ms from good")
def select_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.usable(clips(spark, sf_dir), blocked(spark), LIMITS).select("row_index", "channel_id", "language", "duration_ms")


@query(f"with {SEL} select channel_id, n, total_ms, language from channels")
def channel_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.channel_totals(split.usable(clips(spark, sf_dir), blocked(spark), LIMITS))


@query(f"with {SEL} select channel_id, total_ms, ahead from held")
def holdout_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.holdout_channels(channel_totals(spark, sf_dir), LIMITS).select("channel_id", "total_ms", "ahead")


@query(f"with recursive {CAP} select row_index, channel_id, duration_ms from capped")
def channel_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = split.usable(clips(spark, sf_dir), blocked(spark), LIMITS)
    channels = saved(split.channel_totals(good), "channels")
    held = saved(split.holdout_channels(channels, LIMITS).select("channel_id"), "held")
    without = lambda rows: rows.join(held, "channel_id", "left_anti")
    return split.capped(without(good), LIMITS, without(channels)).select("row_index", "channel_id", "duration_ms")


@query(f"with recursive {SPLIT} select row_index, channel_id, language, duration_ms, split from chosen")
def select_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen(spark, sf_dir).select("row_index", "channel_id", "language", "duration_ms", "split")


@query(f"with recursive {SPLIT} select count(*) as overlap from (select distinct channel_id from chosen where split = 'train' intersect select distinct channel_id from chosen where split = 'holdout')")
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.overlap(chosen(spark, sf_dir))


@query(f"with recursive {SPLIT} select language, sum(duration_ms) / 3600000 as hours from chosen where split = 'train' group by language")
def hours_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.hours_by(chosen(spark, sf_dir), "language")


@query(f"with recursive {SPLIT} select genre, sum(duration_ms) / 3600000 as hours from chosen where split = 'train' group by genre")
def hours_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.hours_by(chosen(spark, sf_dir), "genre")


@query(f"with recursive {SPLIT} select genre, sum(duration_ms)::bigint as total_ms, min(row_index) as first_row from chosen where split = 'train' group by genre order by total_ms desc, first_row limit 10")
def top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.top_by_hours(chosen(spark, sf_dir), "genre")


@query(f"""with recursive {SPLIT}, t as (select coalesce(sum(duration_ms) filter (split = 'train'), 0)::bigint as train_ms from chosen)
select any_value(t.train_ms) as train_ms, coalesce(sum(duration_ms) filter (split = 'holdout'), 0)::bigint as holdout_ms, count(*) filter (split = 'train') as train_segments, count(*) filter (split = 'holdout') as holdout_segments,
 count(distinct channel_id) filter (split = 'train') as train_channels, count(distinct channel_id) filter (split = 'holdout') as holdout_channels, coalesce(max(duration_ms) filter (split = 'train'), 0) as longest_ms,
 (1 - any_value(t.train_ms) / 20000000) * 100 as shortfall_pct, any_value(t.train_ms) < 19000000 as short from chosen, t""")
def selection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stats(chosen(spark, sf_dir), LIMITS)


@query(f"with {CLIPS} select row_number() over (order by total_ms desc, channel_id) as rank, * from (select channel_id, sum(duration_ms)::bigint as total_ms, count(*) as n, coalesce(arg_min(title, row_index) filter (title <> ''), '') as title from clips group by channel_id order by total_ms desc, channel_id limit 10)")
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.top_sources(clips(spark, sf_dir))


@query("select doc_id, replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '|', '\\|') as cell from documents")
def md_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.md_cell(F.col("text")).alias("cell"))


@query("select md5(text) as filename from documents union select md5(text) from benchmark order by filename")
def manifest_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [table(spark, sf_dir, t).select(F.md5("text").alias("filename")) for t in ("documents", "benchmark")]
    return names[0].union(names[1]).distinct().orderBy("filename")


@query("select conv_id, count(*) as n from conversations group by conv_id having count(*) > 1")
def manifest_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.checks import repeated

    return repeated(table(spark, sf_dir, "conversations"), "conv_id")


COPIED = """copied as (select d.doc_id as key, case when p.page_id is null then 'missing' when length(p.html) = t.n_chars then 'skipped' else 'copied' end as status, coalesce(length(p.html), 0) as bytes
  from documents d left join pages p on d.doc_id = p.page_id left join documents t on t.doc_id = d.doc_id)"""


@query(f"with {COPIED} select key, status, bytes from copied")
def copy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.col("n_chars").alias("size"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("k"), F.length("html").cast("long").alias("size")).withColumnRenamed("k", "key")
    out = files.plan(docs.select(F.col("key").alias("wanted")), pages.withColumnRenamed("key", "wanted"), docs.withColumnRenamed("key", "wanted"), "wanted")
    return out.withColumnRenamed("wanted", "key")


@query(f"with {COPIED} select " + ", ".join(f"count(*) filter (status = '{s}') as {s}" for s in ("copied", "skipped", "missing", "failed")) + ", coalesce(sum(bytes) filter (status <> 'missing'), 0)::bigint as bytes, coalesce(sum(bytes) filter (status <> 'missing'), 0) / 1e9::double as gb from copied")
def copy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.rollup(copy_plan(spark, sf_dir))


@query(f"""with {CLIPS}, n as (select *, greatest(1, ceil(duration_ms / 30000))::bigint as k from clips), p as (select *, unnest(range(k)) as part from n)
select case when k = 1 then id else id || '-p' || part::varchar end as cut_id, part * (duration_ms / k) as start_ms, case when part = k - 1 then duration_ms - part * (duration_ms / k) else duration_ms / k end as cut_ms from p""")
def split_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.split_long(clips(spark, sf_dir), 30_000).select("cut_id", "start_ms", "cut_ms")


MERGED = CLIPS + """, short as (select *, row_number() over (partition by channel_id order by row_index) as i from clips where duration_ms < 25000),
fold as (select channel_id, i, 0::bigint as lot, duration_ms::bigint as total from short where i = 1
  union all select s.channel_id, s.i, case when f.total >= 60000 then f.lot + 1 else f.lot end, case when f.total >= 60000 then s.duration_ms else f.total + s.duration_ms end from fold f join short s on s.channel_id = f.channel_id and s.i = f.i + 1),
lots as (select s.channel_id as channel, f.lot, arg_min(s.id, s.row_index) as first_id, count(*) as n, sum(s.duration_ms)::bigint as total_ms, min(s.row_index) as first_row from fold f join short s on s.channel_id = f.channel_id and s.i = f.i group by 1, 2),
merged as (select id as cut_id, channel_id as channel, 1::bigint as n, duration_ms as total_ms, row_index as first_row from clips where duration_ms >= 25000
  union all select case when n = 1 then first_id else 'concat-' || first_id || '-x' || n::varchar end, channel, n, total_ms, first_row from lots where total_ms >= 25000)"""


@query(f"with recursive {MERGED} select * from merged")
def concat_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.merge_short(clips(spark, sf_dir), 25_000, 60_000)


SHARDED = CLIPS + ", sharded as (select *, row_number() over (order by md5('1337:' || id), id) - 1 as position from clips), shards as (select position // 100 as shard_id, * from sharded)"


@query(f"""with {SHARDED}, deal as (select shard_id, (row_number() over (order by md5('1340:' || shard_id::varchar)) - 1) % 8 as worker from (select distinct shard_id from shards))
select row_index, position, shard_id, worker from shards join deal using (shard_id)""")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clips(spark, sf_dir)
    deal = cuts.dealt(cuts.shard_numbers(rows, 100), 1337, 3, 4, 2)
    return cuts.sharded(rows, 1337, 100).join(deal, "shard_id").select("row_index", "position", "shard_id", "worker")


@query(f"with {SHARDED} select shard_id, count(*) as n, sum(duration_ms)::bigint as total_ms, max(duration_ms) as longest_ms from shards group by shard_id")
def shard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.summary(cuts.sharded(clips(spark, sf_dir), 1337, 100))


DEALT = """deal as (select epoch, shard_id, (row_number() over (partition by epoch order by md5((1337 + epoch)::varchar || ':' || shard_id::varchar)) - 1) % 8 as worker
  from (select distinct shard_id from shards), (select unnest([0, 1]) as epoch))"""


@query(f"with {SHARDED}, {DEALT} select row_index, shard_id from shards join deal using (shard_id) where epoch = 1 and worker = 3")
def worker_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one worker reads in an epoch: its shards' folders only."""
    path = fresh_path(spark, "shards")
    writers.shards(cuts.sharded(clips(spark, sf_dir), 1337, 100).select("row_index", "position", "shard_id"), path)
    deal = saved(cuts.dealt(spark.read.parquet(path).select("shard_id").distinct(), 1337, 1, 4, 2), "deal")
    return readers.shards(spark, path, deal=deal.where("worker = 3")).select("row_index", F.col("shard_id").cast("long").alias("shard_id"))


@query(f"with {SHARDED}, {DEALT} select epoch, worker, shard_id, row_index from shards join deal using (shard_id)")
def stream_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs over written shards; the stream stops after its first batch, and another goes on from there."""
    folder = fresh_path(spark, "epochs")
    writers.shards(cuts.sharded(clips(spark, sf_dir), 1337, 100).select("row_index", "position", "shard_id"), f"{folder}/shards")
    stream = lambda: epochs.epochs(spark, f"{folder}/shards", f"{folder}/progress", 1337, 2, shards_per_batch=64, world=4, workers=2, batches_per_epoch=8)
    epochs.run_epochs(stream(), f"{folder}/run", stop_after=1)
    return epochs.run_epochs(stream(), f"{folder}/run").select("epoch", "worker", "shard_id", "row_index")


@query(f"with {SHARDED} select shard_id, position - shard_id * 100 as nth, 'c' || doc_id::varchar as id, strlen(text) as bytes, md5(text) as digest from shards join documents on doc_id = row_index")
def shard_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as archives of a hundred each, read back."""
    path = fresh_path(spark, "archives")
    name = F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id")
    docs = table(spark, sf_dir, "documents")
    places = saved(cuts.sharded(docs.select(name), 1337, 100), "places")  # ranked without the texts
    rows = docs.select(name, F.col("text").cast("binary").alias("payload"), "lang").join(places, "id")
    archives.write_archives(rows, path, extension="txt", compression="gzip")
    back = archives.read_archives(spark, path)
    return back.select("shard_id", F.col("position").alias("nth"), "id", F.octet_length("payload").cast("long").alias("bytes"), F.md5("payload").alias("digest"))


TREE = "lang || '/' || case when doc_id % 3 = 0 then '_' else '' end || source || '/.' || (doc_id % 10)::varchar || '/' || doc_id::varchar || case when doc_id % 5 = 0 then '.WAV' when doc_id % 5 = 1 then '.txt' else '.wav' end"


@query(f"select relpath, size from (select {TREE} as relpath, strlen(text) as size from documents) where lower(relpath) like '%.wav' order by relpath")
def tree_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts as files of a tree, which is then walked."""
    path, id_text = fresh_path(spark, "files"), F.col("doc_id").cast("string")
    name = F.concat("lang", F.lit("/"), F.when(F.col("doc_id") % 3 == 0, "_").otherwise(""), "source", F.lit("/."), (F.col("doc_id") % 10).cast("string"), F.lit("/"), id_text, F.when(F.col("doc_id") % 5 == 0, ".WAV").when(F.col("doc_id") % 5 == 1, ".txt").otherwise(".wav"))
    rows = table(spark, sf_dir, "documents").select(name.alias("name"), F.col("text").cast("binary").alias("content"), "lang")
    files.write(rows, path, "name", "content").agg(F.sum("bytes")).collect()
    folders = [r.lang for r in rows.select("lang").distinct().collect()]  # a row a language
    return tree.walk(spark, path, folders)


@query("select lang as tab, doc_id, n_chars from documents where lang in ('en', 'fr') and n_chars >= 500")
def paged_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as pages of tabs, read with a condition that goes to the source."""
    folder = fresh_path(spark, "pages")
    rows = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars", F.floor(F.col("doc_id") / 400).alias("page"))
    paged.export(rows, folder, "lang", "page")
    tabs = [r.lang for r in rows.select("lang").distinct().collect()]  # a row a tab
    pages = paged.paged(spark, paged.FolderClient(folder, ("n_chars",)), sorted(tabs), "doc_id long, n_chars long")
    return pages.where(F.col("tab").isin("en", "fr") & (F.col("n_chars") >= 500))


@query("""with recursive b as (select doc_id, n_chars, (row_number() over (order by doc_id) - 1) // 256 as buffer from documents), o as (select *, row_number() over (partition by buffer order by n_chars, doc_id) as i from b),
f as (select buffer, i, doc_id, 1::bigint as n, 0::bigint as batch from o where i = 1
  union all select o.buffer, o.i, o.doc_id, case when (f.n + 1) * o.n_chars > 20000 then 1 else f.n + 1 end, case when (f.n + 1) * o.n_chars > 20000 then f.batch + 1 else f.batch end from f join o on o.buffer = f.buffer and o.i = f.i + 1)
select doc_id, buffer, batch from f""")
def pack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.packed(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id", 20_000).select("doc_id", "buffer", "batch")


@query("""with recursive b as (select doc_id, n_chars, (row_number() over (order by doc_id) - 1) // 256 as buffer from documents), o as (select *, row_number() over (partition by buffer order by n_chars, doc_id) as i from b),
f as (select buffer, i, doc_id, 1::bigint as n, 0::bigint as batch from o where i = 1
  union all select o.buffer, o.i, o.doc_id, case when (f.n + 1) * o.n_chars > 20000 then 1 else f.n + 1 end, case when (f.n + 1) * o.n_chars > 20000 then f.batch + 1 else f.batch end from f join o on o.buffer = f.buffer and o.i = f.i + 1)
select doc_id, buffer, batch, dense_rank() over (partition by buffer order by md5('1337:' || buffer::varchar || ':' || batch::varchar)) - 1 as position from f""")
def batch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.dealt(pack_batches(spark, sf_dir), 1337)


@query("""with e as (select vec_id, [x::double for x in embedding] as v from embeddings), m as (select *, list_sum(v) / len(v) as mean from e), s as (select *, list_sum([(x - mean) * (x - mean) for x in v]) / len(v) as var from m)
select vec_id, i - 1 as i, round((v[i] - mean) / sqrt(var + 1e-7), 6) as x from s, (select unnest(range(1, 65)) as i)""")
def normalize_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(arrays.normalized(F.col("embedding"))).alias("i", "x"))
    return v.select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("""with c as (select conv_id, conv_id % 8 as batch, list(length(text) order by turn) as v from conversations group by conv_id), m as (select *, max(len(v)) over (partition by batch) as k from c)
select conv_id, array_to_string(list_concat(v, [0 for x in range(k - len(v))]), ',') as input, array_to_string(list_concat([1 for x in range(len(v))], [0 for x in range(k - len(v))]), ',') as mask from m""")
def pad_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.length("text").cast("long").alias("n"))))["n"].alias("v")).withColumn("batch", F.col("conv_id") % 8)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return batches.padded_batches(rows, "v", "batch").select("conv_id", joined("input"), joined("mask"))


STEPPED = "stepped as (select user_id, value, row_number() over (partition by user_id order by event_id) as step from events)"


@query(f"""with {STEPPED}, r as (select user_id, step, max(step) over (partition by user_id) as updates from stepped), w as (select *, updates // 10 as warm, updates // 10 + floor(0.4::double * (updates - updates // 10))::bigint as held from r)
select user_id, step, round(case when step < warm then 5e-5::double * step / warm when step < held then 5e-5::double else 5e-5::double * pow(pow(0.01::double, 1.0::double / greatest(1, updates - held)), step - held) end, 12) as lr from w""")
def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate at each step of each run; a run's own number of steps is what its schedule is laid over."""
    rows = monitor.stepped(table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "step")
    updates = rows.groupBy("user_id").agg(F.max("step").alias("updates"))
    lr = schedules.tri_stage_lr(F.col("step"), LR["peak"], F.floor(F.col("updates") / 10), LR["hold_ratio"], F.col("updates"))
    return rows.join(updates, "user_id").select("user_id", "step", F.round(lr, 12).alias("lr"))


@query(f"with {STEPPED} select user_id, step, round(greatest(0.5::double, 1.0::double * pow(0.999::double, step)), 9) as temperature from stepped")
def gumbel_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = monitor.stepped(table(spark, sf_dir, "events"), "user_id", "event_id")
    return rows.select("user_id", "step", F.round(schedules.gumbel_temperature(F.col("step"), **TEMP), 9).alias("temperature"))


@query("""with u as (select user_id, count(*) as updates, avg(value) as seconds from events group by user_id)
select user_id, updates, round(updates * 1600.0::double / seconds / 3600, 6) as hours, greatest(1, floor(1600.0::double / seconds))::bigint as accumulate from u""")
def eta_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run of as many updates as a user has events takes at the rate of their mean value, and how many such readings make a batch."""
    runs = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("updates"), F.avg("value").alias("seconds"))
    hours = schedules.eta_hours(F.col("updates"), F.lit(1600.0), F.col("seconds"))
    steps = schedules.accumulation_steps(F.lit(1600.0), F.col("seconds"), F.lit(1))
    return runs.select("user_id", "updates", F.round(hours, 6).alias("hours"), steps.cast("long").alias("accumulate"))



@query(f"with {STEPPED} select user_id, (step - 1) // 50 as interval, count(*) as n, round(avg(value), 6) as mean, round(sum(value), 6) as total, arg_max(value, step) as last, max(step) as last_step from stepped group by 1, 2")
def interval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = monitor.by_interval(monitor.stepped(table(spark, sf_dir, "events"), "user_id", "event_id"), "user_id", "value", 50)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "total")})


@query("""with s as (select user_id, value, case when event_type = 'view' then value end as viewed, epoch(ts) as clock, row_number() over (partition by user_id order by event_id) as step from events),
g as (select user_id, (step - 1) // 20 as i, max(step) as step, coalesce(avg(value), 0) as mean_value, coalesce(avg(viewed), 0) as mean_viewed, coalesce(sum(value), 0) / 20 as value_norm, sum(value) as seconds, arg_max(clock, step) as e, arg_min(clock, step) as b from s group by 1, 2),
t as (select *, e - coalesce(lag(e) over (partition by user_id order by i), b) as elapsed from g)
select user_id, step, round(mean_value, 4) as mean_value, round(mean_viewed, 4) as mean_viewed, round(value_norm, 4) as value_norm, round(case when elapsed > 0 then seconds / elapsed else 0 end, 9) as per_second from t where step % 20 = 0""")
def interval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumns({"viewed": F.when(F.col("event_type") == "view", F.col("value")), "at": F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000})
    out = monitor.interval_report(monitor.stepped(rows, "user_id", "event_id"), "user_id", 20, ["value", "viewed"], "value", "value", "at")
    return out.withColumns({c: F.round(c, 4) for c in ("mean_value", "mean_viewed", "value_norm")} | {"per_second": F.round("per_second", 9)})


@query(f"""with {STEPPED}, low as (select *, value < 20 as low, sum(case when value < 20 then 0 else 1 end) over (partition by user_id order by step) as island from stepped),
runs as (select user_id, step, row_number() over (partition by user_id, island order by step) as n from low where low)
select user_id, min(step) as first_alarm, count(*) as alarms from runs where n >= 5 group by user_id""")
def streak_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.alarms(monitor.stepped(table(spark, sf_dir, "events"), "user_id", "event_id"), "user_id", "value", 20.0, 5)


LISTED = """listed as (select case when event_type = 'error' then 'checkpoint-' || (event_id // 10)::varchar || '-final' else 'checkpoint-' || (event_id // 10)::varchar end as folder, event_type as file from events),
found as (select regexp_extract(folder, '^checkpoint-(\\d+)$', 1)::bigint as step, bool_or(file = 'click') and bool_or(file = 'view') and bool_or(file = 'signup') as complete from listed where regexp_matches(folder, '^checkpoint-\\d+$') group by 1)"""


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("checkpoint-"), F.floor(F.col("event_id") / 10).cast("string"))
    listing = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", F.concat(name, F.lit("-final"))).otherwise(name).alias("folder"), F.col("event_type").alias("file"))
    return monitor.checkpoints(listing, "folder", "file", ["click", "view", "signup"])


@query(f"with {LISTED} select step, step = max(step) over () as newest from found where complete order by step desc")
def checkpoint_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = found(spark, sf_dir)
    newest = monitor.resume_step(rows).withColumnRenamed("step", "newest_step")
    return monitor.newest_first(rows).join(F.broadcast(newest), F.lit(True)).select("step", (F.col("step") == F.col("newest_step")).alias("newest")).orderBy(F.desc("step"))


@query(f"""with {LISTED}, k as (select step, step in (3, 50, 90) as stone from found where complete) select step, stone or row_number() over (partition by stone order by step desc) <= 4 as keep from k""")
def checkpoint_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.retained(found(spark, sf_dir).where("complete").select("step"), [3, 50, 90], 4)


@query(f"with {STEPPED} select user_id, step, value from stepped where step <= 120")
def curve_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.trimmed(monitor.stepped(table(spark, sf_dir, "events"), "user_id", "event_id"), 120).select("user_id", "step", "value")


@query("""with s as (select user_id % 3 as candidate, -avg(case when event_type = 'view' then value end) as score from events group by 1)
select 'checkpoint-' || arg_min(candidate, (score, candidate))::varchar as best, round(min(score), 6) as best_score, count(*) as candidates from s""")
def checkpoint_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("candidate"), F.when(F.col("event_type") == "view", F.col("value")).alias("value"))
    out = bench.best(bench.proxy_score(rows, "candidate", "value", True), "candidate", F.col("candidate"))
    return out.select(F.concat(F.lit("checkpoint-"), F.col("best").cast("string")).alias("best"), F.round("best_score", 6).alias("best_score"), "candidates")


FAMILY = "case when starts_with(event_type, 'click') then 'asr' when starts_with(event_type, 'view') then 'sid' when starts_with(event_type, 'sign') then 'er' when starts_with(event_type, 'error') then 'sd' when starts_with(event_type, 'purch') then 'asv' end"
STATS = f"""stats as (select user_id % 7 as upstream, {FAMILY} as family, avg(value) as mean, coalesce(stddev_samp(value), 0) as std, count(*) as n from events
  where (props->>'k')::bigint % 7 <> 0 and event_type <> 'error' group by 1, 2)"""


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    metric = F.create_map(F.coalesce(*(F.when(F.startswith("event_type", F.lit(p)), F.lit(text.PRIMARY_METRIC.get(f, "der"))) for f, p in PREFIXES.items())), F.col("value"))
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("upstream"), F.col("event_type").alias("name"), F.when(k % 7 != 0, "ok").otherwise("failed").alias("status"), metric.alias("metrics"))
    return bench.family_stats(bench.main_metric(rows, PREFIXES))


@query(f"with {STATS} select upstream, family, round(mean, 6) as mean, round(std, 6) as std, n from stats")
def bench_family_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(f"with {STATS} select u.upstream, " + ", ".join(f"round(max({c}) filter (family = '{f}'), 6) as {f}_{c}" for f in ("asr", "sid", "er", "asv") for c in ("mean", "std")) + " from (select distinct user_id % 7 as upstream from events) u left join stats s on u.upstream = s.upstream group by u.upstream")
def bench_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    upstreams = table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("upstream")).distinct()
    out = bench.report(upstreams, stats(spark, sf_dir), ["asr", "sid", "er", "asv"])
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "upstream"})


@query(f"select event_id, {FAMILY} as family from events")
def family_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", text.family_of(F.col("event_type"), PREFIXES).alias("family"))


@query("select event_id, (props->>'k')::double as k, (props->>'absent')::double as absent from events")
def json_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = lambda n: F.get_json_object("props", f"$.{n}").cast("double")
    return table(spark, sf_dir, "events").select("event_id", field("k").alias("k"), field("absent").alias("absent"))


@query("select conv_id, turn, role || turn::varchar as role, turn::varchar as turn_tag, length(text)::varchar as len, 3 as n from conversations")
def parse_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    value = F.concat(F.lit(" role=x, turn = "), F.col("turn").cast("string"), F.lit(",,len="), F.length("text").cast("string"), F.lit(" , role= "), F.col("role"), F.col("turn").cast("string"))
    rows = labels.refuse_bad_tags(c.withColumn("value", value), "value").withColumn("tags", text.parse_tags(F.col("value")))
    tag = lambda k: F.col("tags")[k]
    return rows.select("conv_id", "turn", tag("role").alias("role"), tag("turn").alias("turn_tag"), tag("len").alias("len"), F.size("tags").alias("n"))


@query("""with r as (select *, 'bench_' || role || '_c' || conv_id::varchar || '_s' || turn::varchar as new_name, 'run-' || conv_id::varchar as name, case when turn = 0 then 'a' else 'b' end as old from conversations where starts_with(md5(conv_id::varchar), 'a'))
select conv_id, turn, new_name, case when old = 'a' then '' else 'model=a,' end || case when turn % 2 = 0 then 'original_run_name=' || name else '' end as new_tags from r""")
def label_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    model = F.when(F.col("turn") == 0, "a").otherwise("b")
    tags = F.when(F.col("turn") % 2 == 0, F.create_map(F.lit("model"), model)).otherwise(F.create_map(F.lit("model"), model, F.lit("original_run_name"), F.lit("x")))
    runs = c.select("conv_id", "turn", "role", F.concat(F.lit("run-"), F.col("conv_id").cast("string")).alias("name"), F.md5(F.col("conv_id").cast("string")).alias("commit"), F.col("turn").alias("start_time"), tags.alias("tags"))
    new = F.concat(F.lit("bench_"), "role", F.lit("_c"), F.col("conv_id").cast("string"), F.lit("_s"), F.col("turn").cast("string"))
    out = labels.changes(labels.wanted(runs, "a"), new, F.create_map(F.lit("model"), F.lit("a")))
    tag = F.concat(F.when(F.map_contains_key("new_tags", F.lit("model")), "model=a,").otherwise(""), F.coalesce(F.concat(F.lit("original_run_name="), F.try_element_at("new_tags", F.lit("original_run_name"))), F.lit("")))
    return out.select("conv_id", "turn", "new_name", tag.alias("new_tags"))


@query("select user_id, event_id // 500 as interval, count(*) as n, round(avg(value), 6) as mean, round(sum(value), 6) as total, arg_max(value, event_id) as last from events group by 1, 2")
def stream_interval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = monitors.interval_metrics(monitors.source(spark, f"{sf_dir}/events.parquet"), "user_id", "event_id", "value", 500)
    return monitors.run_to_end(stream, "complete", fresh_path(spark, "stream")).withColumns({c: F.round(c, 6) for c in ("mean", "total")})


@query("""with low as (select *, value < 20 as low, sum(case when value < 20 then 0 else 1 end) over (partition by user_id order by event_id) as island from events),
runs as (select user_id, event_id, row_number() over (partition by user_id, island order by event_id) as n from low where low) select user_id, min(event_id) as first_alarm from runs where n >= 5 group by user_id""")
def stream_streak_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events come in three lots; after each the stream ends, and the next run goes on from its progress folder."""
    events, folder = table(spark, sf_dir, "events"), fresh_path(spark, "stream")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    bounds = [low, *(low + (high - low) * i // 3 for i in (1, 2)), high + 1]
    out = None
    for i in range(3):
        events.where((F.col("event_id") >= bounds[i]) & (F.col("event_id") < bounds[i + 1])).write.parquet(f"{folder}/in/lot-{i}")
        out = monitors.run_to_end(monitors.streak_alarms(monitors.arriving(spark, f"{folder}/in", events), "user_id", "event_id", "value", 20.0, 5), "append", folder)
    return out


RESUMED = "(select min(event_id) + (max(event_id) - min(event_id)) // 2 from events)"


@query(f"""with low as (select *, value < 20 as low, sum(case when value < 20 then 0 else 1 end) over (partition by user_id order by event_id) as island from events),
runs as (select user_id, event_id, row_number() over (partition by user_id, island order by event_id) as n from low where low)
select user_id, 'alarm' as kind, min(event_id) as step from runs where n >= 5 and event_id > {RESUMED} group by user_id""")
def stream_resumed_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the events is the curve from which the runs resume; the stream has the second half, and replays the end of the first."""
    events, folder = table(spark, sf_dir, "events"), fresh_path(spark, "stream")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    at = low + (high - low) // 2
    events.where(F.col("event_id") > at - (at - low) // 4).write.parquet(f"{folder}/in/lot-0")
    curve = monitor.trimmed(events.withColumnRenamed("event_id", "step"), at).withColumnRenamed("step", "event_id")
    stream = resumed.resumed_alarms(monitors.arriving(spark, f"{folder}/in", events), curve, "user_id", "event_id", "value", 20.0, 5)
    return monitors.run_to_end(stream, "append", folder)


@query(f"with {TABS} select source_id, lang, size, to_train, language, source_tab from tabs")
def catalog_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tabs as a dated catalog; the latest one is read back."""
    folder = fresh_path(spark, "catalog")
    writers.catalog(tabs(spark, sf_dir).drop("duration_minutes"), folder, ["source_id", "to_train"])
    return readers.csv(spark, f"{folder}/catalog_latest").select("source_id", "lang", "size", "to_train", "language", "source_tab")


@query(f"with {RESOLVED} select 'c' || row_index::varchar as id, path as filename, d.lang as language, d.n_chars / 50 as duration, d.source as channel_id from resolved join documents d on d.doc_id = row_index where status = 'resolved'")
def manifest_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolved rows as a manifest, read back."""
    path = fresh_path(spark, "manifest")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_index"), "source", (F.col("n_chars") / 50).alias("duration"))
    rows = resolved(spark, sf_dir).where("status = 'resolved'").join(d, "row_index").select(F.concat(F.lit("c"), F.col("row_index").cast("string")).alias("id"), F.col("path").alias("filename"), F.col("filename").alias("name_in_drive"), "language", "duration", F.col("source").alias("channel_id"))
    writers.manifest(rows, path, path_col="filename")
    return readers.manifest(spark, [path]).select("id", "filename", "language", "duration", "channel_id")


@query(f"with {RESOLVED} select row_index::varchar as row_index, status as reason from resolved where status <> 'resolved'")
def unresolved_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "unresolved")
    writers.unresolved(resolved(spark, sf_dir), path, ["row_index", "language"])
    return readers.csv(spark, path).select("row_index", "reason")


@query("select lang as folder, count(*) as n, sum(strlen(text)) / 1e9::double as gb from documents group by lang")
def index_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of the texts, written and read back."""
    path = fresh_path(spark, "index")
    rows = table(spark, sf_dir, "documents").select(F.concat_ws("/", "lang", "source", F.col("doc_id").cast("string")).alias("relpath"), F.octet_length("text").cast("long").alias("size"))
    writers.index(rows, path)
    return files.index_totals(readers.index(spark, path))


@query(f"with {LISTED} select step, step in (select step from found where complete) as there from (select unnest([3, 7, 50, 90, 1000000]) as step)")
def milestone_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.milestones(found(spark, sf_dir), [3, 7, 50, 90, 1_000_000])


@query(f"with {STEPPED} select user_id, (step - 1) // 50 as interval, step, value from stepped where step <= 120")
def curve_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curves of many runs, by interval and bucket of runs: the second interval and those after it are written twice, then what lies behind a step is taken out."""
    path = fresh_path(spark, "curve")
    rows = monitor.stepped(table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", F.floor((F.col("step") - 1) / 50).cast("long").alias("interval"), "step", "value")
    writers.curve(rows.withColumn("value", F.when(F.col("interval") == 0, F.col("value")).otherwise(-1.0)), path, "user_id", buckets=32)
    writers.curve(rows.where("interval >= 1"), path, "user_id", buckets=32)
    writers.trim_curve(spark, path, 120, run="user_id")
    kept = spark.read.schema(rows.schema).parquet(path)
    return kept.select("user_id", "interval", "step", "value")


@query("""select doc_id::varchar || '.txt' as filename, 'copied' as status, strlen(text) as bytes from documents
union all select 'gone-' || item_id::varchar, 'missing', 0 from benchmark""")
def copied_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts as files, copied by URI in bins of like bytes; those of benchmark aren't there."""
    folder = fresh_path(spark, "files")
    rows = table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), F.col("text").cast("binary").alias("content"))
    made = saved(files.write(rows, f"{folder}/source", "filename", "content"), "made")
    gone = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("gone-"), F.col("item_id").cast("string")).alias("filename"), F.lit(0).cast("long").alias("bytes"))
    return files.copy_until_done(made.unionByName(gone), f"{folder}/source", f"{folder}/target", size="bytes").select("filename", "status", "bytes")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_split(spark, sf_dir)
