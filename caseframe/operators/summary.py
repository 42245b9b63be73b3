"""One mergeable summary of the fact rows, from which the screens take all they show.

A row of it holds the sums and counts of a disease, a county, a sex, a year or of
everything. All of them come from one scan by grouping sets, and the row with the
highest rate is found on the way. Sums and counts add up, so the summaries of two
sets make that of both without a look at their rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from caseframe.operators.overview import growth_of, max_rate_order
from caseframe.operators.places import drawn
from caseframe.schema import ALL_DISEASES, NOT_AVAILABLE, SEXES
from caseframe.sources.working import materialise

KEYS = ("Disease", "County", "Sex", "Year")
SUMS = ("n_rows", "cases", "rate_sum", "rate_n", "population_sum", "population_n")


def summarise(rows: DataFrame) -> DataFrame:
    """``level`` (``All`` or the name of a key), the keys, and the sums of its rows.

    Keys other than that of the level are null; a row whose own key is missing
    counts in the level's row with a null key.
    """
    sets = [[], *([key] for key in KEYS)]
    grouped = rows.groupingSets(sets, *KEYS).agg(
        F.grouping_id(*KEYS).alias("_id"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("Count").alias("cases"),
        F.sum("Recalculated_Rate").alias("rate_sum"),
        F.count("Recalculated_Rate").alias("rate_n"),
        F.sum("Population").alias("population_sum"),
        F.count("Population").alias("population_n"),
    )
    # A bit of the id is 0 where the key is part of the set.
    whole, level = 2 ** len(KEYS) - 1, F.lit("All")
    for place, key in enumerate(reversed(KEYS)):
        level = F.when(F.col("_id") == whole - 2**place, F.lit(key)).otherwise(level)
    return grouped.select(level.alias("level"), *KEYS, *SUMS)


def merged(*tables: DataFrame) -> DataFrame:
    """The summary of all rows that the given ones summarise."""
    united = tables[0]
    for table in tables[1:]:
        united = united.unionByName(table)
    return united.groupBy("level", *KEYS).agg(*(F.sum(name).alias(name) for name in SUMS))


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.col(total), F.col(n))


@dataclass
class Summary:
    """What the screens show of a table, without reading it again.

    ``rows`` are read for the preview alone, and of these only the diseases that
    come first.
    """

    table: DataFrame
    highest: DataFrame
    rows: DataFrame

    @staticmethod
    def of(rows: DataFrame) -> "Summary":
        """Runs the one job: writes the summary and learns the row with the highest rate."""
        seen = Observation()
        whole_row = F.struct(*(F.col(f"`{name}`") for name in rows.columns))
        told = rows.observe(seen, F.min_by(whole_row, max_rate_order()).alias("highest"))
        table = materialise(summarise(told))
        # Of a table without rows nothing is observed either.
        row = None if table.isEmpty() else seen.get["highest"]
        highest = rows.sparkSession.createDataFrame([] if row is None else [row], rows.schema)
        return Summary(table, highest, rows)

    def merged_with(self, other: "Summary") -> "Summary":
        """The summary of both sets of rows, from the two tables."""
        rows = self.rows.unionByName(other.rows, allowMissingColumns=True)
        both = self.highest.unionByName(other.highest, allowMissingColumns=True)
        highest = both.orderBy(max_rate_order()).limit(1)
        return Summary(materialise(merged(self.table, other.table)), highest, rows)

    def level(self, key: str) -> DataFrame:
        """The rows of a level whose key is known."""
        own = self.table.filter(F.col("level") == key)
        return own if key == "All" else own.filter(F.col(key).isNotNull())

    def _chart(self, key: str) -> DataFrame:
        return self.level(key).select(
            key, F.col("cases").alias("Cas_Totaux"), _mean("rate_sum", "rate_n").alias("Taux_Moyen")
        )

    def key_figures(self, disease: str | None = None) -> DataFrame:
        """As ``overview.key_figures``; one row also where there is no row at all."""

        def largest(key):
            own = (F.col("level") == key) & F.col(key).isNotNull()
            first = F.struct(-F.coalesce("cases", F.lit(0)), F.col(key))
            return F.coalesce(F.min_by(key, F.when(own, first)), F.lit(NOT_AVAILABLE))

        whole = F.col("level") == "All"
        chosen = disease if disease and disease != ALL_DISEASES else None
        return self.table.agg(
            F.coalesce(F.max(F.when(whole, F.col("cases"))), F.lit(0)).alias("Total_Cases"),
            F.max(F.when(whole, _mean("rate_sum", "rate_n"))).alias("Avg_Rate"),
            largest("County").alias("Top_County"),
            (F.lit(chosen) if chosen else largest("Disease")).alias("Top_Disease"),
        )

    def max_rate_row(self) -> DataFrame:
        return self.highest

    def disease_chart(self, limit: int = 10) -> DataFrame:
        return self._chart("Disease").orderBy(F.desc("Cas_Totaux"), "Disease").limit(limit)

    def sex_chart(self) -> DataFrame:
        chosen = self.level("Sex").filter(F.col("Sex").isin(*SEXES))
        return chosen.select("Sex", F.col("cases").alias("Count")).orderBy("Sex")

    def yearly_chart(self) -> DataFrame:
        return self._chart("Year").orderBy("Year")

    def year_growth(self) -> DataFrame:
        return growth_of(self.level("Year").select("Year", F.coalesce("cases", F.lit(0)).alias("cases")))

    def map_layer(self, coordinates: DataFrame) -> DataFrame:
        means = self.level("County").select(
            "County",
            F.col("cases").alias("Total_Count"),
            _mean("rate_sum", "rate_n").alias("Mean_Rate"),
            _mean("population_sum", "population_n").alias("Population"),
        )
        return drawn(means, coordinates)

    def preview(self, n: int = 100) -> DataFrame:
        """The first rows, read from the diseases that hold them.

        The summary tells how many rows each disease has, so the scan is given the
        last disease that is needed; the window spans one row per disease.
        """
        so_far = F.sum("n_rows").over(Window.orderBy(F.asc_nulls_first("Disease")))
        enough = (
            self.table.filter(F.col("level") == "Disease")
            .select("Disease", so_far.alias("so_far"))
            .filter(F.col("so_far") >= n)
            .orderBy(F.asc_nulls_first("Disease"))
            .first()
        )
        disease, rows = F.col("Disease"), self.rows
        if enough is not None:
            missing = disease.isNull()
            last = enough["Disease"]
            rows = rows.filter(missing if last is None else missing | (disease <= last))
        order = [c for c in ("Disease", "County", "Year", "Sex", "Id") if c in rows.columns]
        return rows.orderBy(*order).limit(n)
