import hashlib
import json

import pytest
from pyspark.sql import functions as F

from skyphrase import config, schemas
from skyphrase.functions import ids, prompt, rng
from skyphrase.plans.scenario import Sampler
from skyphrase.sources import dims

DERIVED = ["callsign", "aircraft_type", "wake", "operator_class", "n_aircraft", "is_emergency", "is_towered"]


@pytest.fixture(scope="module")
def rows(spark):
    return Sampler(spark, config.load(), 7).rows(400).orderBy("id").collect()


def test_same_seed_same_rows_on_any_partitioning(spark, rows):
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    again = Sampler(spark, config.load(), 7).rows(400).orderBy("id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert again == rows
    assert Sampler(spark, config.load(), 8).rows(5).orderBy("id").collect() != rows[:5]


def test_offset_is_the_suffix(spark, rows):
    assert Sampler(spark, config.load(), 7).rows(400, start=380).orderBy("id").collect() == rows[380:]


def test_id_is_the_digest_of_canonical_json(rows):
    for r in rows:
        own = r["scenario"].asDict(recursive=True)
        for name in DERIVED:
            own.pop(name)
        assert hashlib.sha1(json.dumps(own, sort_keys=True, separators=(",", ":")).encode()).hexdigest() == r["scenario_id"]


def test_rules(rows):
    c = config.load()
    for r in (r["scenario"] for r in rows):
        low, high = c.traffic_aircraft_range[r["traffic_density"]]
        assert low <= len(r["aircraft"]) <= high and r["n_aircraft"] == len(r["aircraft"])
        assert r["squawk"] not in config.RESERVED_SQUAWKS and set(r["squawk"]) <= set("01234567") and len(r["squawk"]) == 4
        low, high = c.phase_frequency_bands[r["phase"]]
        assert low <= r["frequency_mhz"] <= high
        w = r["weather"]
        if w["vmc_imc"] == "VMC":
            assert w["vis_sm"] >= 5 and (w["ceiling_ft"] is None or w["ceiling_ft"] >= 5000)
        else:
            assert 0.25 <= w["vis_sm"] <= 3 and 100 <= w["ceiling_ft"] <= 2000
        assert r["region"] == "us"
        assert (r["sid_star"] is None) >= (r["phase"] in ("ground", "ramp"))
        assert r["callsign"] == r["aircraft"][0]["callsign"] and r["is_emergency"] == r["event"].startswith("emergency_")
        assert all(a["operator_class"] in config.CLASSES and a["wake"] in config.WAKES for a in r["aircraft"])
    assert {r["scenario"]["vmc_imc"] if "vmc_imc" in r["scenario"] else r["scenario"]["weather"]["vmc_imc"] for r in rows} == {"VMC", "IMC"}


def test_overrides(spark):
    c = config.load()
    picked = Sampler(spark, c, 1, event_weights={"nordo": 1.0}, operator_weights={"cargo": 1.0}, regions={"canada"}).rows(20).collect()
    assert {r["scenario"]["event"] for r in picked} == {"nordo"} and {r["scenario"]["icao"] for r in picked} <= {"CYYZ", "CYVR", "CYUL", "CYYC"}
    assert {a["operator_class"] for r in picked for a in r["scenario"]["aircraft"]} == {"cargo"}
    own = spark.createDataFrame([("KSFO", 1.0), ("KJFK", 1.0), ("EGLL", 9.0)], schemas.WEIGHT)
    assert {r["scenario"]["icao"] for r in Sampler(spark, c, 1, weights=own).rows(40).collect()} == {"KSFO", "KJFK"}
    with pytest.raises(ValueError):
        Sampler(spark, c, 1, regions={"atlantis"})
    assert Sampler(spark, c, 1, regions=[]).rows(3).count() == 3


def test_regions(spark):
    wanted = {
        "KSFO": "us", "PHNL": "us", "CYYZ": "canada", "EGLL": "uk", "EIDW": "uk", "EDDF": "europe_west", "LFPG": "europe_west", "EPWA": "europe_east", "LTFM": "me", "RJAA": "asia_east",
        "ZBAA": "asia_east", "VTBS": "asia_se", "WSSS": "asia_se", "YSSY": "oceanic", "OMDB": "me", "SBGR": "lat_am", "MMMX": "lat_am", "FAOR": "africa",
    }
    got = {r["icao"]: r["region"] for r in dims.airports(spark).collect()}
    assert {k: got.get(k) for k in wanted} == wanted
    odd = spark.createDataFrame([("XXXX", None), ("FJDG", "IO"), ("GCLP", "ES"), ("EGYP", "FK"), ("LFVP", "PM"), ("SCRM", "AQ"), ("SAWB", "AQ")], "icao string, country string")
    known = {r["icao"]: r["region"] for r in dims.with_region(odd, dims.countries(spark)).collect()}
    assert known == {"XXXX": "other", "FJDG": "other", "GCLP": "europe_west", "EGYP": "lat_am", "LFVP": "lat_am", "SCRM": "other", "SAWB": "other"}


def test_countries(spark, tmp_path):
    """How many countries each region has, and one or two of each."""
    rows = {r["country"]: r["region"] for r in dims.countries(spark).collect()}
    many = {"us": 7, "canada": 1, "uk": 2, "europe_west": 25, "europe_east": 21, "me": 24, "asia_east": 8, "asia_se": 18, "oceanic": 19, "lat_am": 50, "africa": 56}
    assert len(rows) == sum(many.values()) == 231 and {r: sum(x == r for x in rows.values()) for r in many} == many
    some = {
        "PR": "us", "UM": "us", "CA": "canada", "IE": "uk", "AD": "europe_west", "GL": "europe_west", "XK": "europe_east", "RU": "europe_east", "AF": "me", "TR": "me", "HK": "asia_east", "MN": "asia_east",
        "PK": "asia_se", "VN": "asia_se", "CK": "oceanic", "GU": "us", "FK": "lat_am", "PM": "lat_am", "GF": "lat_am", "EG": "africa", "RE": "africa", "ST": "africa", "SS": "africa",
    }
    assert {k: rows[k] for k in some} == some and not {"AQ", "IO", "SH"} & set(rows)
    (tmp_path / "own.csv").write_text("country,region\nAQ,polar\n")
    own = dims.countries(spark, (tmp_path / "own.csv").as_uri())
    assert {r["icao"]: r["region"] for r in dims.airports(spark, regions=own).collect()}["SCRM"] == "polar"


def test_towered(rows):
    assert config.TOWERED == ["ground", "tower", "approach", "center"]
    assert {r["scenario"]["phase"]: r["scenario"]["is_towered"] for r in rows} == {"ground": True, "tower": True, "approach": True, "center": True, "ramp": False}


def test_aircraft_dimension(spark):
    found = dims.by_class(dims.aircraft(spark)).select("operator_class", F.size("members").alias("n")).collect()
    assert {r["operator_class"]: r["n"] for r in found} == {"commercial": 40, "ga": 12, "business": 11, "military": 11, "training": 8, "cargo": 7, "rotorcraft": 7, "medevac": 6}


def test_custom_weights_last_row_counts(spark, tmp_path):
    (tmp_path / "w.csv").write_text("icao,weight\nKSFO,1\nKJFK,2\nKSFO,5\n")
    assert {r["icao"]: r["weight"] for r in dims.custom_weights(spark, (tmp_path / "w.csv").as_uri()).collect()} == {"KSFO": 5.0, "KJFK": 2.0}


def test_config():
    c = config.load()
    assert config.available() == ["us"] and len(c.airport_tiers) == 86 and abs(sum(c.event_weights.values()) - 100.9) < 1e-9
    with pytest.raises(config.ConfigNotFound):
        config.load("nowhere")
    import dataclasses

    raw = dataclasses.asdict(c)
    with pytest.raises(ValueError):
        config.parse(raw | {"more": 1})
    with pytest.raises(ValueError):
        config.parse(raw | {"sid_star_none_chance": 1.5})
    with pytest.raises(ValueError):
        config.parse(raw | {"phase_weights": {"taxi": 1}})


def test_prompt(spark):
    row = Sampler(spark, config.load(), 3).rows(1).select("scenario", prompt.messages(F.col("scenario")).alias("m")).first()
    system, user = row["m"]
    s = row["scenario"]
    assert (system["role"], user["role"]) == ("system", "user") and "plain text" in system["content"].lower()
    for text in (s["icao"], s["runway"], s["squawk"], s["event"], f"{s['frequency_mhz']:.2f} MHz", "[FOCAL] " + s["callsign"]):
        assert text in user["content"]


def test_squawk_codes_are_all_but_the_reserved(spark):
    codes = [r[0] for r in spark.range(4093).select(rng.squawk((F.col("id") + 0.5) / 4093)).collect()]
    assert sorted(codes) == [f"{c:04o}" for c in range(4096) if f"{c:04o}" not in config.RESERVED_SQUAWKS]


def test_fingerprint_ignores_the_order_of_regions():
    assert ids.fingerprint("m", 1, "p", "t", "w", ["b", "a"], "us") == ids.fingerprint("m", 1, "p", "t", "w", ["a", "b"], "us") and len(ids.fingerprint("m", 1, "p", "t", "w", [], "us")) == 16


def test_schema_compiler():
    from dataclasses import dataclass
    from typing import Literal

    from pyspark.sql import types as T

    @dataclass
    class Inner:
        a: int
        b: float | None

        @property
        def double(self) -> int:
            return 2 * self.a

    assert schemas.spark_type(list[Inner]).elementType.names == ["a", "b", "double"]
    assert schemas.spark_type(Literal["x", "y"]) == T.StringType()
    for odd in (dict, int | str, Literal["x", 1], tuple[int]):
        with pytest.raises(TypeError):
            schemas.spark_type(odd)


def test_checks_name_what_is_broken(spark, rows):
    from skyphrase.functions import checks

    one = Sampler(spark, config.load(), 7).rows(1)
    assert one.select(checks.scenario_errors(F.col("scenario"))).first()[0] == []
    s = F.col("scenario")
    odd = one.select(s.withField("phase", F.lit("taxi")).withField("squawk", F.lit("7500")).withField("weather.wind_kt", F.lit(81)).withField("weather.ceiling_ft", F.lit(None).cast("long")).withField("region", F.lit(None).cast("string")).alias("scenario"))
    assert odd.select(checks.scenario_errors(F.col("scenario"))).first()[0] == ["region", "phase", "squawk", "weather.wind_kt"]


def test_public_names():
    from skyphrase import api

    assert all(hasattr(api, name) for name in api.__all__)


def test_a_draw_is_hashed_once(spark, sf_dir):
    """No draw is hashed again by each comparison with it: the plan mentions few hashes, and those of an aircraft once each."""
    from skyphrase.plans import catalogue

    for query in (catalogue.scenario_sample, catalogue.prompt_briefing):
        plan = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.count("sha1(") <= 12, plan.count("sha1(")
