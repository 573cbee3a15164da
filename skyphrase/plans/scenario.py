"""The scenario sampler: rows of a range of ids, every draw a Column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TOWERED, RegionConfig
from ..functions import ids, rng
from ..operators import lookups
from ..sources import dims

TAXONOMY_VERSION = "t1"
LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ"  # without I and O
# The draws of a row, apart from its airport's and its aircraft's.
SLOTS = [
    "phase", "density", "time", "event", "sky", "many", "heading", "side", "nosid", "letter:0", "letter:1", "letter:2", "letter:3", "sid", "squawk", "frequency",
    "direction", "windy", "wind", "vis", "cloud", "ceiling", "altimeter",
]


class Sampler:
    """Draws scenarios; equal seeds and settings give equal rows for equal ids, on any partitioning.

    ``weights`` (icao, weight) replaces the tier weights, ``regions`` the allowed regions if not empty.
    """

    def __init__(
        self, spark: SparkSession, config: RegionConfig, seed: int = 42, *, airports: DataFrame | None = None, aircraft: DataFrame | None = None, weights: DataFrame | None = None,
        regions: Iterable[str] | None = None, event_weights: Mapping[str, float] | None = None, operator_weights: Mapping[str, float] | None = None, fast: bool = False,
    ):
        self.spark, self.config, self.seed, self.fast = spark, config, seed, fast
        ports = dims.airports(spark) if airports is None else airports
        allowed = sorted(regions or config.allowed_regions)
        pool = ports.where(F.col("region").isin(allowed))
        weights = dims.tier_weights(pool, config) if weights is None else weights.join(pool.select("icao"), "icao", "left_semi")
        if weights.where("weight > 0").isEmpty():
            raise ValueError(f"no airport with a weight in the regions {', '.join(allowed)}")
        self.intervals = lookups.cumulative(weights).join(pool.select("icao", "region"), "icao")
        craft = dims.by_class(dims.aircraft(spark) if aircraft is None else aircraft)
        self.members = {r["operator_class"]: [(m["icao_type"], m["wake"]) for m in r["members"]] for r in craft.collect()}  # a row per class
        given = operator_weights or config.operator_weights
        self.operators = {k: v for k, v in given.items() if self.members.get(k)}
        self.events = event_weights or config.event_weights

    def hashed(self, *slot: Column) -> Column:
        """The draw of a slot whose name is that of these columns in a row."""
        return rng.fast_uniform(self.seed, F.col("id"), F.concat(*slot)) if self.fast else rng.fraction(F.concat(F.col("_stem"), *slot))

    def u(self, slot: str) -> Column:
        """A row's draw, one of ``SLOTS``.  They are hashed once, as an array: what is made of them stays short enough to be
        compiled, and no draw is hashed again by each comparison with it."""
        return F.col("_u")[SLOTS.index(slot)]

    def rows(self, count: int, start: int = 0) -> DataFrame:
        """(id, scenario_id, scenario) of the ids start to count - 1."""
        return self.of(self.spark.range(start, count))

    def of(self, numbered: DataFrame) -> DataFrame:
        """The scenarios of the ids of a table, whose other columns come along."""
        more = [c for c in numbered.columns if c != "id"]
        drawn = lookups.pick(numbered, (rng.fast_uniform if self.fast else rng.uniform)(self.seed, F.col("id"), "icao"), self.intervals, "icao", more=["region"])
        drawn = drawn.withColumn("_stem", rng.stem(self.seed, F.col("id"))).withColumn("_u", F.transform(F.array(*map(F.lit, SLOTS)), lambda slot: self.hashed(slot)))
        c, phase = self.config, F.col("phase")
        drawn = drawn.select(
            *more, "id", "_stem", "_u", "icao", "region", rng.weighted(self.u("phase"), c.phase_weights).alias("phase"), rng.weighted(self.u("density"), c.traffic_density_weights).alias("traffic_density"),
            rng.weighted(self.u("time"), c.time_of_day_weights).alias("time_of_day"), rng.weighted(self.u("event"), self.events).alias("event"), rng.weighted(self.u("sky"), c.weather.vmc_imc_weights).alias("sky"),
        )
        drawn = drawn.withColumn("aircraft", self._aircraft())
        scenario = F.struct(
            F.col("icao"), F.col("region"), phase, F.col("aircraft"), self._runway().alias("runway"), self._sid_star().alias("sid_star"), rng.squawk(self.u("squawk")).alias("squawk"),
            self._frequency().alias("frequency_mhz"), self._weather().alias("weather"), F.col("time_of_day"), F.col("traffic_density"), F.col("event"), *derived(),
        )
        return drawn.select("id", *more, scenario.alias("scenario")).select("id", ids.scenario_id(F.col("scenario")).alias("scenario_id"), "scenario", *more)

    def _aircraft(self) -> Column:
        ranges = self.config.traffic_aircraft_range
        low, high = (F.element_at(F.create_map(*[F.lit(x) for k, r in ranges.items() for x in (k, int(r[end]))]), F.col("traffic_density")) for end in (0, 1))

        def own(name: str) -> Column:
            """What a class draws from."""
            crafts = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in self.members[name]])
            prefixes = F.array(*map(F.lit, self.config.operator_prefixes.get(name) or [])).cast("array<string>")
            return F.struct(F.lit(name).alias("name"), crafts.alias("crafts"), prefixes.alias("prefixes"))

        # a literal that is looked up: a bound value is copied
        table, place = F.array(*map(own, self.operators)), {name: k for k, name in enumerate(self.operators)}

        def one(k: Column) -> Column:
            drawn = lambda what: self.hashed(F.lit(f"{what}:"), k.cast("string"))

            def row(number: Column) -> Column:
                kind = F.get(table, number)
                prefixed = F.concat(rng.choice(drawn("prefix"), kind["prefixes"]), rng.integer(drawn("number"), 1, 9999).cast("string"))
                width = rng.integer(drawn("width"), 1, 5).cast("int")  # N and one to five digits
                plain = F.concat(F.lit("N"), F.substr(F.lpad(rng.integer(drawn("number"), 0, 99999).cast("string"), 5, "0"), F.lit(1), width))
                sign = F.when(F.size(kind["prefixes"]) > 0, prefixed).otherwise(plain)
                return rng.bound(
                    rng.choice(drawn("craft"), kind["crafts"]),
                    lambda craft: F.struct(sign.alias("callsign"), craft["t"].alias("aircraft_type"), craft["w"].alias("wake"), kind["name"].alias("operator_class")),
                )

            return rng.bound(rng.bound(drawn("class"), lambda u: rng.weighted(u, self.operators, lambda name: F.lit(place[name]))), row)

        return F.transform(F.sequence(F.lit(0).cast("long"), rng.integer(self.u("many"), low, high) - 1), one)

    def _runway(self) -> Column:
        return F.concat(F.lpad(rng.integer(self.u("heading"), 1, 36).cast("string"), 2, "0"), rng.weighted(self.u("side"), self.config.runway_suffix_weights))

    def _sid_star(self) -> Column:
        letters = [F.substr(F.lit(LETTERS), (rng.integer(self.u(f"letter:{k}"), 1, len(LETTERS))).cast("int"), F.lit(1)) for k in range(4)]
        name = F.concat(*letters, rng.integer(self.u("sid"), 1, 9).cast("string"))
        none = F.col("phase").isin("ground", "ramp") | (self.u("nosid") < self.config.sid_star_none_chance)
        return F.when(~none, name)

    def _frequency(self) -> Column:
        out = None
        for phase, (low, high) in self.config.phase_frequency_bands.items():
            value = F.round(rng.real(self.u("frequency"), low, high), 2)
            out = F.when(F.col("phase") == phase, value) if out is None else out.when(F.col("phase") == phase, value)
        return out

    def _weather(self) -> Column:
        w, clear = self.config.weather, F.col("sky") == "VMC"
        seen = F.when(clear, F.round(rng.real(self.u("vis"), *w.vmc_vis_sm), 1)).otherwise(F.round(rng.real(self.u("vis"), *w.imc_vis_sm), 2))
        high = F.when(clear, F.when(self.u("cloud") < w.vmc_ceiling_chance, rng.integer(self.u("ceiling"), *w.vmc_ceiling_ft))).otherwise(rng.integer(self.u("ceiling"), *w.imc_ceiling_ft))
        buckets = {str(k): b["weight"] for k, b in enumerate(w.wind_kt_buckets)}
        bucket = rng.weighted(self.u("windy"), buckets)
        wind = F.coalesce(*[F.when(bucket == str(k), rng.integer(self.u("wind"), *b["range"])) for k, b in enumerate(w.wind_kt_buckets)])
        return F.struct(
            rng.integer(self.u("direction"), *w.wind_dir_deg).alias("wind_dir_deg"), wind.alias("wind_kt"), seen.alias("vis_sm"), high.alias("ceiling_ft"),
            F.round(rng.real(self.u("altimeter"), *w.altimeter_inhg), 2).alias("altimeter_inhg"), F.col("sky").alias("vmc_imc"),
        )


def derived(aircraft: Column | None = None, event: Column | None = None, phase: Column | None = None) -> list[Column]:
    """The columns that follow from the others: those of the focal aircraft, its company, and two flags."""
    aircraft = F.col("aircraft") if aircraft is None else aircraft
    event, phase = F.col("event") if event is None else event, F.col("phase") if phase is None else phase
    focal = [F.get(aircraft, F.lit(0))[f].alias(f) for f in ("callsign", "aircraft_type", "wake", "operator_class")]
    return [*focal, F.size(aircraft).cast("long").alias("n_aircraft"), event.startswith("emergency_").alias("is_emergency"), phase.isin(TOWERED).alias("is_towered")]
