"""The three datasets: fixed schemas, keys and the order in which rows of one crawl win."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.functions import catalogue, sizes
from vernissage.functions.scalars import let
from vernissage.operators.dedup import SortField, winners

_SOURCE = "source_file string, crawled_at timestamp"


@dataclass(frozen=True)
class Dataset:
    name: str
    key: str
    ddl: str
    order: tuple[SortField, ...]

    @property
    def schema(self) -> T.StructType:
        return T._parse_datatype_string(self.ddl)

    @property
    def entity_type(self) -> str:
        return self.name.removesuffix("s")

    def conform(self, df: DataFrame, keep: Sequence[str] = ("platform_name", "crawl_date")) -> DataFrame:
        """Exactly the dataset's columns and types: absent ones null, others dropped, bad values null."""
        have = {f.name: f.dataType for f in df.schema}

        def fits(f: T.StructField) -> bool:
            # Only truth values are truth values: "yes" and 1 are not.
            return f.name in have and (not isinstance(f.dataType, T.BooleanType) or isinstance(have[f.name], T.BooleanType))

        cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) if fits(f) else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        return df.select(*[c for c in keep if c in have], *cols).filter(F.col(self.key).isNotNull() & (F.col(self.key) != ""))

    def winners(self, df: DataFrame) -> DataFrame:
        return winners(df, ["platform_name", "crawl_date", self.key], self.order)

    def ids(self, df: DataFrame) -> DataFrame:
        """Adds ``entity_id`` and ``version_id``."""
        entity = F.concat_ws(":", "platform_name", self.key)
        return df.withColumn("entity_id", entity).withColumn("version_id", F.concat_ws(":", entity, F.col("crawl_date").cast("string")))


#: The datasets' columns in their order.
ARTWORKS = Dataset(
    "artworks", "platform_artwork_id",
    "platform_artwork_id string, title string, artist_name string, platform_artist_id string, artwork_url string, category string, width_cm double, height_cm double, depth_cm double, "
    "price decimal(14,2), currency string, year smallint, subject string, description string, styles array<string>, mediums array<string>, dimensions_cm string, dimensions_in string, "
    "width_in double, height_in double, depth_in double, is_available_for_sale boolean, ships_from_country string, dimensions string, is_sold boolean, is_price_on_request boolean, image_url string, "
    "technique string, support string, is_ai_generated boolean, has_certificate boolean, is_signed boolean, substrate string, materials string, signature string, has_detail boolean, " + _SOURCE,
    (SortField("has_detail"), SortField("crawled_at"), SortField("source_file")),
)
ARTISTS = Dataset(
    "artists", "platform_artist_id",
    "platform_artist_id string, full_name string, profile_url string, avatar string, birth_year smallint, death_year smallint, gender string, biography string, website string, facebook string, "
    "instagram string, tiktok string, twitter string, nationality string, city string, state string, zip_code string, country string, " + _SOURCE,
    (SortField("crawled_at"), SortField("source_file")),
)
LOTS = Dataset(
    "lots", "platform_lot_id",
    "platform_lot_id string, lot_url string, lot_number string, title string, description string, artist_name string, category string, image_url string, currency string, low_estimate decimal(14,2), "
    "high_estimate decimal(14,2), price_realized decimal(14,2), sale_status string, sale_id string, sale_title string, sale_date date, sale_url string, selling_house_name string, is_result boolean, "
    "has_detail boolean, height_cm double, width_cm double, depth_cm double, medium string, year smallint, is_signed boolean, artist_birth_year smallint, artist_death_year smallint, "
    "artist_nationality string, sale_location string, department string, " + _SOURCE,
    (SortField("is_result"), SortField("has_detail"), SortField("crawled_at"), SortField("source_file")),
)
DATASETS = {d.name: d for d in (ARTWORKS, ARTISTS, LOTS)}


def fill_from_catalogue(lots: DataFrame, as_of: int, text: str = "description", title: str = "title", artist: str = "artist_name") -> DataFrame:
    """Size, medium, year, signature and life dates from the catalogue text where the row has none."""
    facts = lots.withColumn("_size", sizes.size_cm(text)).withColumn("_life", catalogue.life(artist))
    born = F.coalesce(F.col("artist_birth_year").cast("int"), F.col("_life.born"))
    unsized = F.col("height_cm").isNull() & F.col("width_cm").isNull()
    found = {
        # A size is taken as a whole: a height of the row does not go with a width of the text.
        "height_cm": F.when(unsized, F.col("_size.height")), "width_cm": F.when(unsized, F.col("_size.width")), "depth_cm": F.when(unsized, F.col("_size.depth")), "medium": catalogue.medium(text), "is_signed": catalogue.is_signed(text),
        "artist_birth_year": F.col("_life.born").cast("smallint"), "artist_death_year": F.col("_life.died").cast("smallint"), "artist_nationality": F.col("_life.nationality"),
        "year": let(catalogue.year_made(text, title, born, as_of), lambda y: y.cast("smallint")),
    }
    return facts.select(*[F.coalesce(F.col(c), found[c]).alias(c) if c in found else F.col(c) for c in lots.columns])
