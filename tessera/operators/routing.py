"""System routing of requests.

The registry is configuration (a few dozen rows), turned into small
DataFrames; their size is fixed by the configuration, not by the data, so
they are broadcast.  Requests never shuffle: every step is a broadcast left
join plus ``coalesce``.  Errors are rows (``error`` column), not exceptions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (the reference's built-in registry).
SYSTEM_TO_LANGS = {"kkenru": [("kk", "en"), ("en", "kk"), ("kk", "ru"), ("ru", "kk"), ("en", "ru"), ("ru", "en")]}
AUDIO_TYPE_SYSTEMS_MAP = {"faen": "fsen", "soen": "spen", "kken": "kken_no_punct", "kaen": "kaen_no_punct"}
AUDIO_SYSTEMS_TO_LANGS = {"fsen": ("fs", "en"), "spen": ("sp", "en")}
QUERY_TYPE_SYSTEMS_MAP = {"kken": "kken_query", "kaen": "kaen_query"}
SYSTEM_TO_TEXT_PROCESSOR = {
    "DEFAULT": "MosesSubwordNmtTextProcessor",
    "enps": "NormSubwordNmtTextProcessor",
    "psen": "NormSubwordNmtTextProcessor",
    "kkenru": "MultilingualSpmTextProcessor",
    "kken_query": "QueryMosesSubwordNmtTextProcessor",
    "kken_no_punct": "RemovePunctMosesSubwordNmtTextProcessor",
    "kken": "MosesNormPunctMosesSubwordNmtTextProcessor",
    "enkk": "MosesNormPunctMosesSubwordNmtTextProcessor",
    "kaen": "SpmTextProcessor",
    "enka": "SpmTextProcessor",
    "kaen_query": "QuerySpmTextProcessor",
    "kaen_no_punct": "RemovePunctMosesSubwordNmtTextProcessor",
}
PASSTHROUGH_SYSTEMS = {"kaen", "enka", "kaen_query"}


@dataclass
class Registry:
    installed: list[str]
    system_to_langs: dict = field(default_factory=lambda: dict(SYSTEM_TO_LANGS))
    audio_map: dict = field(default_factory=lambda: dict(AUDIO_TYPE_SYSTEMS_MAP))
    audio_langs: dict = field(default_factory=lambda: dict(AUDIO_SYSTEMS_TO_LANGS))
    query_map: dict = field(default_factory=lambda: dict(QUERY_TYPE_SYSTEMS_MAP))
    processors: dict = field(default_factory=lambda: dict(SYSTEM_TO_TEXT_PROCESSOR))
    passthrough: set = field(default_factory=lambda: set(PASSTHROUGH_SYSTEMS))

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        def df(rows, schema):
            return spark.createDataFrame(rows, schema)
        dirs = [(k, f"{a}{b}") for k, v in self.system_to_langs.items() for a, b in v]
        return {
            "installed": df([(s,) for s in self.installed], "system string"),
            "directions": df(dirs or [("", "")], "cand string, direction string"),
            "audio_map": df(list(self.audio_map.items()), "target string, audio_system string"),
            "query_map": df(list(self.query_map.items()), "target string, query_system string"),
            "audio_langs": df([(k, a, b) for k, (a, b) in self.audio_langs.items()],
                              "system string, audio_src string, audio_tgt string"),
            "processors": df([(k, v) for k, v in self.processors.items() if k != "DEFAULT"],
                             "system string, processor string"),
            "passthrough": df([(s,) for s in sorted(self.passthrough)], "system string"),
        }


def route(requests: DataFrame, registry: Registry) -> DataFrame:
    """Add ``system, processor, passthrough, src_eff, tgt_eff, error``.

    ``requests`` has ``src_lang, tgt_lang, type, query BOOLEAN, system``
    (``system`` may be null).  The direction table is aggregated first (one
    row per direction: how many systems serve it, and which), so the
    fallback is a single broadcast join, not a per-request grouping.
    """
    spark = requests.sparkSession
    t = registry.frames(spark)
    default_proc = registry.processors.get("DEFAULT")
    df = requests.withColumn("_target", F.coalesce(F.col("system"), F.concat("src_lang", "tgt_lang")))
    # Audio map, then query map (coalesce keeps the current name when absent)
    df = (df.join(F.broadcast(t["audio_map"]), F.col("_target") == F.col("target"), "left")
            .withColumn("_target", F.when(F.col("type") == "audio", F.coalesce("audio_system", "_target"))
                        .otherwise(F.col("_target"))).drop("target", "audio_system"))
    df = (df.join(F.broadcast(t["query_map"]), F.col("_target") == F.col("target"), "left")
            .withColumn("_target", F.when(F.col("query"), F.coalesce("query_system", "_target"))
                        .otherwise(F.col("_target"))).drop("target", "query_system"))
    # installed? else candidates by language direction
    inst = t["installed"].withColumnRenamed("system", "_inst_sys").withColumn("_installed", F.lit(True))
    df = df.join(F.broadcast(inst), F.col("_target") == F.col("_inst_sys"), "left")
    cands = (t["directions"].groupBy("direction")
             .agg(F.count("*").alias("_n_cand"), F.min("cand").alias("_cand")))
    df = df.join(F.broadcast(cands), F.col("_target") == F.col("direction"), "left")
    installed = F.coalesce(F.col("_installed"), F.lit(False))
    n = F.coalesce(F.col("_n_cand"), F.lit(0))
    system = F.when(installed, F.col("_target")).when(n == 1, F.col("_cand"))
    error = (F.when(installed | (n == 1), F.lit(None).cast("string"))
              .when(n > 1, F.concat(F.lit("ambiguous system for "), F.col("_target")))
              .otherwise(F.concat(F.lit("unrecognized system: "), F.col("_target"))))
    df = df.withColumn("_system", system).withColumn("error", error)
    # Text processor with DEFAULT; audio systems' real languages
    df = (df.join(F.broadcast(t["processors"].withColumnRenamed("system", "_ps")), F.col("_system") == F.col("_ps"), "left")
            .withColumn("processor", F.when(F.col("_system").isNotNull(),
                                            F.coalesce("processor", F.lit(default_proc)))))
    df = df.join(F.broadcast(t["audio_langs"].withColumnRenamed("system", "_as")), F.col("_system") == F.col("_as"), "left")
    audio = (F.col("type") == "audio") & F.col("_as").isNotNull()
    df = (df.withColumn("src_eff", F.when(audio, F.col("audio_src")).otherwise(F.col("src_lang")))
            .withColumn("tgt_eff", F.when(audio, F.col("audio_tgt")).otherwise(F.col("tgt_lang"))))
    # Passthrough systems turn placeholder protection on
    pt = t["passthrough"].withColumnRenamed("system", "_pt").withColumn("_is_pt", F.lit(True))
    df = df.join(F.broadcast(pt), F.col("_system") == F.col("_pt"), "left")
    df = df.withColumn("passthrough", F.coalesce(F.col("_is_pt"), F.lit(False)))
    drop = ["_target", "_inst_sys", "_installed", "direction", "_n_cand", "_cand", "_ps", "_as", "audio_src",
            "audio_tgt", "_pt", "_is_pt"]
    return df.drop(*drop).drop("system").withColumnRenamed("_system", "system")
