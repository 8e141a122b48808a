"""From processed segments to a model matrix."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward.functions import metrics, text
from windward.operators.filters import keep_members
from windward.schemas import require_columns

SEED = 13
AGE_CLASSES = ["U17", "U19"]
# The categories a segment can have. Other tables of categories are an argument.
CATEGORIES = {
    "sex": ["Men", "Women"],
    "age_class": AGE_CLASSES,
    "point_of_sail": sorted(label for _, label in metrics.POINTS_OF_SAIL),
}


@dataclass(frozen=True)
class Preset:
    """Which columns feed a model and how."""

    target: str
    numeric: list[str]
    categorical: list[str]
    angles: list[str] = field(default_factory=list)
    unused: list[str] = field(default_factory=list)
    young_only: bool = True
    drop_before_encode: bool = True

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.angles, *self.categorical, self.target]


# The columns of each preset.
PRESETS = {
    # The wide set; it contains outcomes of the segment itself.
    "rank_v1": Preset(
        target="rank_segment",
        numeric=["segment_efficiency_pct", "wind_speed_kn", "segment_speed_kn", "segment_vmc_kn",
                 "speed_wind_ratio", "temperature_c", "pressure_hpa", "humidity_pct", "rain_mm",
                 "rank_entry", "rank_segment_end"],
        categorical=["sex", "age_class", "point_of_sail"],
        angles=["wind_dir_site"],
        drop_before_encode=False,
    ),
    # Only what is known before the segment is sailed.
    "rank_v2": Preset(
        target="rank_segment",
        numeric=["wind_speed_kn", "temperature_c", "pressure_hpa", "humidity_pct", "rain_mm", "rank_entry"],
        categorical=["sex", "age_class", "point_of_sail"],
        angles=["wind_dir_site"],
        unused=["pressure_hpa", "rain_mm"],
    ),
    "readme_vmc": Preset(
        target="segment_vmc_kn",
        numeric=["total_length_m", "temperature_c", "pressure_hpa", "humidity_pct", "wind_speed_kn",
                 "rank_entry"],
        categorical=["point_of_sail", "sex"],
        young_only=False,
    ),
}
DEFAULT_PRESET = "rank_v2"


def circular_encode(df: DataFrame, column: str) -> DataFrame:
    """An angle in degrees as its sine and cosine; the angle itself goes."""
    angle = F.radians(F.col(column).cast("double"))
    return df.withColumns({f"{column}_sin": F.sin(angle), f"{column}_cos": F.cos(angle)}).drop(column)


def category_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): the observed values of category columns, in one pass and left on the cluster.

    Write it as a table, and read from there what ``one_hot`` is to know.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).select("p.*").where("value is not null").distinct()


def one_hot(df: DataFrame, values: dict[str, list]) -> DataFrame:
    """One 0/1 column per category value; a null gives zeros throughout."""
    flags = {
        f"{column}_{value}": F.when(F.col(column) == F.lit(value), 1).otherwise(0)
        for column, listed in values.items()
        for value in listed
    }
    return df.withColumns(flags).drop(*values)


def numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Decimal-comma texts to doubles; columns that are numbers already are only widened."""
    types = dict(df.dtypes)
    return df.withColumns({
        c: text.decimal_comma(F.col(c)) if types[c] == "string" else F.col(c).cast("double")
        for c in columns
    })


def model_matrix(
    df: DataFrame,
    preset: Preset | str = DEFAULT_PRESET,
    values: dict[str, list] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Filtered and encoded features with the target; ``keep`` carries row keys along.

    ``values`` lists the categories, by default the fixed ones; a value outside
    the list gives zeros throughout. The plan reads its input once and runs no job.
    """
    p = PRESETS[preset] if isinstance(preset, str) else preset
    keep = keep or []
    data = require_columns(df, p.columns).select(*dict.fromkeys([*keep, *p.columns]))
    data = numeric(data, [*p.numeric, *p.angles, p.target])
    if p.young_only and "age_class" in p.categorical:
        data = keep_members(data, "age_class", AGE_CLASSES)
    if p.drop_before_encode:
        data = data.na.drop(subset=p.columns)
    else:
        data = data.na.drop(subset=[*p.numeric, *p.angles, p.target])
    values = values or CATEGORIES
    for angle in p.angles:
        data = circular_encode(data, angle)
    return one_hot(data, {c: values[c] for c in p.categorical}).drop(*p.unused)


def feature_names(matrix: DataFrame, target: str, keep: list[str] | None = None) -> list[str]:
    return [c for c in matrix.columns if c != target and c not in (keep or [])]


def assemble(matrix: DataFrame, features: list[str], target: str) -> DataFrame:
    """All features in one vector column; the target as ``label``."""
    vector = VectorAssembler(inputCols=features, outputCol="features")
    return vector.transform(matrix).withColumn("label", F.col(target).cast(T.DoubleType()))


def encoder_stages(preset: Preset | str, features: list[str], values: dict[str, list] | None = None) -> list[Transformer]:
    """The encoding of ``model_matrix`` and ``assemble`` as stages of a saved model: rows with a null number go,
    numbers, angles and categories become features, features one vector."""
    p = PRESETS[preset] if isinstance(preset, str) else preset
    said = lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    number = lambda c: f"cast(replace(cast(`{c}` as string), ',', '.') as double)"
    columns = {c: number(c) for c in p.numeric}
    for a in p.angles:
        columns |= {f"{a}_sin": f"sin(radians({number(a)}))", f"{a}_cos": f"cos(radians({number(a)}))"}
    for c in p.categorical:
        columns |= {f"{c}_{v}": f"case when `{c}` = {said(v)} then 1 else 0 end" for v in (values or CATEGORIES)[c]}
    kept = ", ".join(f"{expression} as `{name}`" for name, expression in columns.items() if name in features)
    read = ", ".join(f"`{c}`" for c in dict.fromkeys([*p.numeric, *p.angles, *p.categorical]))
    whole = " and ".join(f"`{c}` is not null" for c in [*p.numeric, *p.angles])
    encode = SQLTransformer(statement=f"select * except ({read}), {kept} from __THIS__ where {whole}")
    return [encode, VectorAssembler(inputCols=features, outputCol="features")]


def hash_number(key: Column, modulus: int, salt: str = "") -> Column:
    """A number in 0..modulus-1 from the row key: the same in every run and engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % modulus).cast("int")


def with_split(df: DataFrame, key: Column, train_pct: int = 80, salt: str = f":{SEED}") -> DataFrame:
    """``is_train`` for a fixed share of the row keys; survives re-reads and retries."""
    return df.withColumn("is_train", hash_number(key, 100, salt) < train_pct)


def with_fold(df: DataFrame, key: Column, folds: int = 3, salt: str = f":fold{SEED}") -> DataFrame:
    return df.withColumn("fold", hash_number(key, folds, salt))
