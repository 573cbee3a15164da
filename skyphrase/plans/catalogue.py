"""The query catalogue: each operator on the driver's tables.  ``oracle.py`` has the SQL of the same results."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config
from ..functions import audio, checks, ids, prompt, rng, turns
from ..operators import lookups, select
from ..scratch import Scratch, written
from ..sinks.shards import ShardSink, notice_rows
from ..sources import corpora, dims, registry, replay
from ..streaming import turns_stream
from . import generate, voices
from .scenario import Sampler, derived

SEED = 42
LANGUAGES = ["fr", "en", "es", "de"]  # sources in an order of their own


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, which goes with its owner (``scratch.owned``)."""
    return Scratch(spark, "catalogue").top


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, turns): the lines of ``ROLE: text`` parsed.  Lines of a conversation are parsed turn by turn,
    which gives the same turns as its whole text, and no conversation is gathered in one place."""
    rows = _table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", turns.parse_turns(F.concat(F.upper("role"), F.lit(": "), F.col("text"))).alias("turns"))


def _focal(conv_id: str = "conv_id") -> F.Column:
    return F.when(F.col(conv_id) % 2 == 0, "user").otherwise("system")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, n_turns, error), from sums and sets of tags by conversation."""
    rows = _turns(spark, sf_dir).withColumn("tags", turns.speakers(F.col("turns")))
    tags = rows.select("conv_id", F.explode_outer("tags").alias("tag")).groupBy("conv_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    counts = rows.groupBy("conv_id").agg(F.sum(F.size("turns")).alias("n_turns"))
    few = F.format_string("only %d turns parsed (min %d)", F.col("n_turns"), F.lit(turns.MIN_TURNS))
    absent = F.concat(F.lit("focal callsign '"), F.upper(_focal()), F.lit("' not found among speakers ['"), F.array_join("tags", "', '"), F.lit("']"))
    error = F.when(F.col("n_turns") < turns.MIN_TURNS, few).when(~F.array_contains("tags", F.upper(_focal())), absent)
    return counts.join(tags, "conv_id").select("conv_id", "n_turns", error.alias("error"))


def parse_turns(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", F.posexplode("turns").alias("line", "t")).select("conv_id", "turn", F.col("line").cast("long").alias("line"), "t.speaker", "t.text")


def validate_transcripts(spark, sf_dir):
    return _judged(spark, sf_dir)


def transcript_outcomes(spark, sf_dir):
    return _judged(spark, sf_dir).agg(
        F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.count_if(F.col("error").startswith("only")).alias("too_few")
    )


def distinct_speakers(spark, sf_dir):
    rows = _turns(spark, sf_dir)
    return rows.select("conv_id", F.explode(turns.speakers(F.col("turns"))).alias("speaker")).distinct()


def first_per_speaker(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").where(F.col("n_chars").isNull() | F.col("n_chars").between(200, 5000))
    return select.first_per_key(rows, "source", "doc_id")


def longest_per_speaker(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").where(F.col("n_chars").between(100, 3000))
    return select.longest_per_key(rows, "source", "n_chars", "doc_id")


def accept_clip(spark, sf_dir):
    clips = _table(spark, sf_dir, "embeddings").join(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "n_chars"), "vec_id")
    ok = audio.accepted(F.col("n_chars") / 50, audio.rms(F.col("embedding")), 10.0, 60.0, -20.0)
    return clips.select("vec_id", ok.alias("accepted"))


def voice_ids(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", ids.voice_id(F.col("source"), F.col("doc_id").cast("string")).alias("voice_id"))


def canonical_ids(spark, sf_dir):
    text = F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_size").alias("size")), {"ignoreNullFields": "false"})
    return _table(spark, sf_dir, "part").select("p_partkey", F.sha1(text.cast("binary")).alias("part_id"))


def resume_anti(spark, sf_dir):
    return select.without(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels"), "doc_id")


def resume_offset(spark, sf_dir):
    """Ids still to draw after an interrupted run: the range from an offset on, minus those written, here the labelled documents."""
    end = (_table(spark, sf_dir, "documents").agg(F.max("doc_id")).first()[0] or 0) + 1
    return select.without(spark.range(min(100, end), end).withColumnRenamed("id", "doc_id"), _table(spark, sf_dir, "labels"), "doc_id")


def region_lookup(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    out = lookups.two_hop(_table(spark, sf_dir, "customer"), nation, "c_nationkey", _table(spark, sf_dir, "region"), "r_regionkey", "r_name", "other", "region")
    return out.select("c_custkey", "region")


def _ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(icao, country): customers' numbers as codes, of four letters if they have four digits, and the first letters of their nations."""
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.substring("n_name", 1, 2).alias("country"))
    rows = _table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    return rows.select(F.translate(F.col("c_custkey").cast("string"), "0123456789", "ABCDEFGHIJ").alias("icao"), "country")


def region_rule(spark, sf_dir):
    return dims.coded(_ports(spark, sf_dir), dims.countries(spark)).select("icao", "region")


def country_regions(spark, sf_dir):
    """Suppliers with the region of a country: known ones, two letters that few countries have, and none."""
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    known = F.when(F.col("s_suppkey") % 7 != 0, F.substring("n_name", 1, 2)).when(F.col("s_suppkey") % 2 == 0, F.lower(F.substring("n_name", 1, 2)))
    return dims.with_region(_table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select("s_suppkey", known.alias("country")), dims.countries(spark))


def tier_weights(spark, sf_dir):
    """The weights of all airports, and of two codes that aren't one's, with the customers that are dealt to each, a row for
    each of these; a code without customers has one row."""
    codes = sorted({r["icao"] for r in dims.airports(spark).select("icao").collect()} | set(config.load().airport_tiers) | {"YYYY", "ZZZZ"})  # a row for each airport
    listed = spark.createDataFrame(list(enumerate(codes)), "place long, icao string")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", F.pmod(F.col("c_custkey"), F.lit(len(codes))).cast("long").alias("place"))
    return dims.tier_weights(listed.join(customers, "place", "left"), config.load(), more=["c_custkey"])


def operator_multimap(spark, sf_dir):
    """Nations by what they belong to: their region, and the first letter of their name."""
    region = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rows = _table(spark, sf_dir, "nation").join(region, "n_regionkey").select("n_name", F.array("r_name", F.substring("n_name", 1, 1)).alias("classes"))
    found = lookups.members(rows, "classes", "members", "n_name")
    return found.select(F.col("member_of").alias("operator_class"), F.size("members").cast("long").alias("n_aircraft"), F.array_join("members", ",").alias("members"))


def allowed_regions(spark, sf_dir):
    wanted = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region").where(F.col("r_name").isin("ASIA", "EUROPE")), F.expr("n_regionkey = r_regionkey"), "left_semi")
    return _table(spark, sf_dir, "customer").join(wanted, F.expr("c_nationkey = n_nationkey"), "left_semi").select("c_custkey", "c_nationkey")


def _sampler(spark: SparkSession) -> Sampler:
    return Sampler(spark, config.load(), SEED)


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, scenario_id, scenario) of each order's number.  A scan task holds many of these few bytes each, and a draw takes
    a hundred hashes: numbers are dealt out before they are drawn."""
    numbers = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    return _sampler(spark).of(numbers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id"))


def scenario_sample(spark, sf_dir):
    s = F.col("scenario")
    w = s["weather"]
    # doubles as whole numbers: engines write the last digit of a rounded double differently
    whole = lambda x, scale: F.round(x * scale).cast("long")
    return _drawn(spark, sf_dir).select(
        "id", "scenario_id", *[s[f].alias(f) for f in ("icao", "region", "phase", "runway", "sid_star", "squawk", "time_of_day", "traffic_density", "event", "callsign", "aircraft_type", "wake", "operator_class", "n_aircraft", "is_emergency", "is_towered")],
        F.array_join(F.transform(s["aircraft"], lambda a: F.concat_ws("/", a["callsign"], a["aircraft_type"], a["operator_class"])), ",").alias("roster"),
        w["wind_dir_deg"].alias("wind_dir_deg"), w["wind_kt"].alias("wind_kt"), w["ceiling_ft"].alias("ceiling_ft"), w["vmc_imc"].alias("vmc_imc"),
        whole(s["frequency_mhz"], 100).alias("frequency_khz10"), whole(w["vis_sm"], 100).alias("vis_sm_100"), whole(w["altimeter_inhg"], 100).alias("altimeter_100"),
    )


def prompt_briefing(spark, sf_dir):
    s = F.col("scenario")
    asked = prompt.messages(s)
    return _drawn(spark, sf_dir).select(
        "id", prompt.roster(s).alias("roster"), F.size(asked).cast("long").alias("n_messages"), F.array_join(F.transform(asked, lambda m: m["role"]), ",").alias("roles"), asked[1]["content"].alias("request")
    )


def event_mix(spark, sf_dir):
    events = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return events.select(rng.weighted(rng.uniform(SEED, F.col("id"), "event"), config.load().event_weights).alias("event")).groupBy("event").agg(F.count("*").alias("n"))


def squawk_codes(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", rng.squawk(rng.uniform(SEED, F.col("o_orderkey"), "squawk")).alias("squawk"))


def weighted_choice(spark, sf_dir):
    parts = lookups.cumulative(_table(spark, sf_dir, "part"), "p_partkey", "p_size")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    return lookups.pick(orders, rng.uniform(SEED, F.col("o_orderkey"), "part"), parts, "p_partkey")


def notice_report(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("source", F.col("lang").alias("license"), F.substring("source", 1, 4).alias("attribution"))
    return notice_rows(rows).select("source", "voices", F.array_join("licenses", ", ").alias("licenses"), F.array_join("attributions", ", ").alias("attributions"))


def target_limit(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    parts = [docs.where(F.col("lang") == s).withColumn("ord", F.col("doc_id")) for s in LANGUAGES]
    labels = _table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct().withColumn("there", F.lit(True))
    rows = select.concatenated(parts).join(labels, "doc_id", "left")
    out = select.up_to_target(rows, ["source", "lang"], "ord", F.col("n_chars").between(500, 4000), F.coalesce("there", F.lit(False)), 30)
    return out.select("doc_id", "source", "lang", "kept", "skipped")


def shard_assignment(spark, sf_dir):
    placed = select.sharded(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", 100)
    return placed.groupBy("shard_id").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


def failure_replay(spark, sf_dir):
    line = F.when(F.col("event_id") % 10 == 0, F.expr("substring(props, 2)")).otherwise(F.col("props"))
    read = _table(spark, sf_dir, "events").select("event_type", replay.parsed(line, "k string").alias("r"))
    return read.groupBy("event_type").agg(F.count_if(F.col("r._corrupt_record").isNull()).alias("readable"), F.count_if(F.col("r._corrupt_record").isNotNull()).alias("corrupt"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(F.col("event_id") % 7 != 0).alias("ok"), F.count("*").alias("count"), F.sum((F.col("event_id") % 100).cast("long")).alias("wall"))
    rate = F.when(F.col("wall") > 0, F.round(F.col("ok").cast("decimal(20,6)") / F.col("wall"), 3)).otherwise(0)
    fail = F.when(F.col("count") > 0, F.round(100 * (F.col("count") - F.col("ok")).cast("decimal(20,6)") / F.col("count"), 2)).otherwise(0)
    return rows.select("event_type", "ok", "count", "wall", rate.cast("double").alias("rate_per_sec"), fail.cast("double").alias("fail_pct"))


def benchmark_points(spark, sf_dir):
    return _points(spark, sf_dir)


def benchmark_best(spark, sf_dir):
    """The point of the highest rate, the first on a tie."""
    return _points(spark, sf_dir).agg(F.min_by("event_type", F.struct(-F.col("rate_per_sec"), F.col("event_type"))).alias("best"), F.max("rate_per_sec").alias("rate_per_sec"))


def derived_flags(spark, sf_dir):
    items = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_shipdate").cast("string").alias("callsign"), F.col("l_linestatus").alias("aircraft_type"), F.col("l_returnflag").alias("wake"), F.col("l_returnflag").alias("operator_class")))).alias("aircraft")
    )
    event = F.when(F.col("o_orderpriority") == "1-URGENT", "emergency_fuel").when(F.col("o_orderpriority") == "2-HIGH", "minimum_fuel_advisory").otherwise("routine")
    flags = derived(F.col("aircraft"), event, F.get(F.array(*map(F.lit, config.PHASES)), (F.col("o_orderkey") % 5).cast("int")))
    return items.join(_table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")).select("l_orderkey", *flags)


def domain_errors(spark, sf_dir):
    """Rows by the rules that they break: closed sets and ranges, as scenarios are checked."""
    rules = {
        "status": checks.one_of(F.col("o_orderstatus"), ["F", "O"]), "price": checks.within(F.col("o_totalprice"), 1000, 300000), "priority": F.col("o_orderpriority").rlike("^[1-4]-"),
    }
    rows = _table(spark, sf_dir, "orders").select(F.explode(checks.broken(rules)).alias("rule"))
    return rows.groupBy("rule").agg(F.count("*").alias("n"))


def scenario_errors(spark, sf_dir):
    """Drawn scenarios, some of them spoiled, by the rules that they break."""
    drawn = written(_drawn(spark, sf_dir).select("id", "scenario"))
    spoiled = F.col("scenario")
    for k, field, value in ((5, "squawk", "7700"), (7, "icao", "K1"), (11, "phase", "taxi"), (13, "weather.wind_kt", 81), (17, "n_aircraft", 99), (19, "weather.ceiling_ft", None)):
        spoiled = spoiled.withField(field, F.when(F.col("id") % k == 0, F.lit(value)).otherwise(F.col(f"scenario.{field}")))
    rows = drawn.select("id", F.explode_outer(checks.scenario_errors(spoiled)).alias("rule"))
    return rows.groupBy(F.coalesce("rule", F.lit("none")).alias("rule")).agg(F.count("*").alias("n"))


def voice_records(spark, sf_dir):
    """Candidates to records: pool of the source, id, duration, and the four stored columns' sources."""
    pools = F.create_map(*[F.lit(x) for k in range(10) for x in (f"src{k}", f"pool{k % 3}")])
    source, speaker = F.col("source"), F.col("doc_id").cast("string")
    return _table(spark, sf_dir, "documents").select(
        ids.voice_id(source, speaker).alias("voice_id"), source, speaker.alias("source_speaker_id"), F.concat_ws("-", source, speaker).alias("source_clip_id"),
        (F.col("n_chars") / F.lit(16.0)).alias("duration_s"), F.coalesce(pools[source], F.lit("")).alias("sub_pool"), F.col("lang").alias("language"),
    )


def source_order(spark, sf_dir):
    """Sources one after the other, each in its order."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    return select.concatenated([docs.where(F.col("lang") == s).withColumn("ord", F.col("doc_id")) for s in LANGUAGES]).select("ord", "doc_id", "lang")


def outcome_windows(spark, sf_dir):
    """The stream's counts of accepted and failed outputs per window, over a batch."""
    raw = F.when(F.col("event_id") % 3 == 0, "A: 1").otherwise("A: 1\nB: 2\nA: 3\nB: 4")
    rows = _table(spark, sf_dir, "events").select(raw.alias("raw"), F.lit("b").alias("focal"), F.col("ts").alias("at"))
    out = turns_stream.outcome_rate(rows, "1 day")
    return out.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "ok", "failed")


def generate_stub(spark, sf_dir):
    """Outcomes of the generation stage with the deterministic client, over a run's own output folder."""
    out, settings = _generated(spark, sf_dir)
    sink = generate.open_sink(spark, out, settings)
    good, failed = sink.existing(), generate.recorded(sink)
    return good.select("scenario_id", F.lit("ok").alias("outcome"), F.size("turns").cast("long").alias("n_turns")).unionByName(
        failed.select("scenario_id", F.substring_index("error", ":", 1).alias("outcome"), F.lit(0).cast("long").alias("n_turns"))
    )


def _generated(spark: SparkSession, sf_dir: str) -> tuple[str, generate.RunConfig]:
    """The output folder of a finished run with the deterministic client, of a scenario for each customer."""
    out = f"{_scratch(spark)}/generate"
    settings = generate.RunConfig(model="stub", count=_table(spark, sf_dir, "customer").count(), concurrency=8, shard_size=RUN_SHARD)
    generate.run(_sampler(spark), out, settings, generate.stub_client)
    return out, settings


RUN_SHARD = 5000


def run_report(spark, sf_dir):
    """What a run's folder says of itself: shards and rows by digests and by manifest, the failures, and those that a
    second try leaves."""
    out, settings = _generated(spark, sf_dir)
    generate.rerun(spark, out, settings, generate.stub_client)
    digests = spark.read.json(f"{out}/digests").agg(F.count("*").alias("shards"), F.sum("rows").alias("n_rows"))
    manifest = spark.read.json(f"{out}/manifest.json", multiLine=True).select(F.col("total_rows").alias("manifest_rows"), F.col("last_shard_index").alias("last_shard"))
    lines = lambda path, name: spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "").agg(F.count("*").alias(name))
    found = [digests, manifest, lines(f"{out}/failures.2*.jsonl", "failures"), lines(f"{out}/failures.jsonl", "again_failed")]
    rows = None
    for df in found:
        own = df.select(F.explode(F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("long"))])).alias("what", "n"))
        rows = own if rows is None else rows.unionByName(own)
    return rows


def fingerprints(spark, sf_dir):
    """The fingerprint of a run for each order: its number as seed, its clerk as model, regions of one or two names."""
    key = F.col("o_orderkey")
    regions = F.when(key % 2 == 1, F.array(F.lit("us"), F.lit("canada"))).otherwise(F.array(F.lit("us")))
    fixed = {k: F.lit(v) for k, v in (("prompt_version", "p"), ("taxonomy_version", "t1"), ("weighter_name", "tier_v1"), ("config_name", "us"))}
    return _table(spark, sf_dir, "orders").select("o_orderkey", ids.fingerprints({"model": F.col("o_orderpriority"), "seed": key.cast("long"), "regions": regions, **fixed}).alias("fingerprint"))


def custom_weights(spark, sf_dir):
    """Weights files with several rows of a key: the last counts."""
    path = f"{_scratch(spark)}/weights"
    rows = _table(spark, sf_dir, "part").repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
    rows.select(F.col("p_brand").alias("icao"), F.col("p_size").alias("weight")).write.csv(path, header=True)
    return dims.custom_weights(spark, path)


def corpus_order(spark, sf_dir):
    """Rows of several folders' files, in the order of the folders, then of the files: a folder for each language."""
    top, docs = _scratch(spark), _table(spark, sf_dir, "documents").select("doc_id", "lang")
    for lang in LANGUAGES:
        docs.where(F.col("lang") == lang).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.parquet(f"{top}/{lang}")
    rows = corpora.numbered(spark, [f"{top}/{lang}" for lang in LANGUAGES])
    file, row = F.shiftright("ord", 32), F.col("ord").bitwiseAND(F.lit((1 << 32) - 1))
    counts = rows.groupBy(file.alias("file")).agg(F.count("*").alias("n"))  # a row per file
    before = counts.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return rows.withColumn("file", file).join(before, "file").select((F.col("before") + row).alias("place"), "doc_id", "lang")


def _samples(data: bytes):
    """Raw 32-bit floats as samples, four a second."""
    import numpy as np

    return np.frombuffer(data, dtype="<f4"), 4


def voice_pool(spark, sf_dir):
    """The pool that embeddings, taken for clips of the speakers that their labels are, fill up to a target of 15."""
    @F.pandas_udf("binary")
    def packed(vectors: pd.Series) -> pd.Series:
        return vectors.map(lambda v: struct.pack(f"<{len(v)}f", *v))

    def candidates(session: SparkSession) -> DataFrame:
        none = F.lit(None).cast("string")
        return _table(session, sf_dir, "embeddings").select(
            F.col("vec_id").alias("ord"), F.lit("emb").alias("source"), F.concat_ws("-", "label", F.col("vec_id") % 7).alias("source_speaker_id"), F.col("vec_id").cast("string").alias("source_clip_id"),
            packed("embedding").alias("bytes"), F.concat(F.lit("clip "), F.col("vec_id")).alias("text"), F.lit("L").alias("license"), F.lit("A").alias("attribution"), none.alias("gender_hint"), F.lit("en").alias("language"),
        )

    out = f"{_scratch(spark)}/voices"
    voices.build(spark, [registry.Source("emb", "pool", candidates)], out, 15, voices.Filter(1.0, 60.0, -20.0), shard_size=4, decode=_samples)
    return ShardSink(spark, out, 4).existing().select("voice_id", "source_clip_id", "text", F.octet_length(F.col("audio.bytes")).cast("long").alias("n_bytes"))


NAMES = [
    parse_turns, validate_transcripts, transcript_outcomes, distinct_speakers, first_per_speaker, longest_per_speaker, accept_clip, voice_ids, canonical_ids, resume_anti,
    resume_offset, region_lookup, region_rule, country_regions, tier_weights, operator_multimap, allowed_regions, scenario_sample, prompt_briefing, event_mix, squawk_codes, weighted_choice,
    notice_report, target_limit, shard_assignment, failure_replay, benchmark_points, benchmark_best, derived_flags, domain_errors,
    scenario_errors, voice_records, source_order, outcome_windows, generate_stub,
    run_report, fingerprints, custom_weights, corpus_order, voice_pool,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}
