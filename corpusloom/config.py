"""A run's settings, as given in a file, turned into expressions; unknown settings are errors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from corpusloom.functions import html, urls
from corpusloom.operators import tabular


@dataclass(frozen=True)
class Settings:
    """html_processing: ids, tags and classes that are left out of pages, and whether code is. select_condition: rows that are taken.
    column_types: casts. url_patterns: include and exclude."""

    html_processing: dict = field(default_factory=dict)
    select_condition: str = ""
    column_types: dict = field(default_factory=dict)
    url_patterns: dict = field(default_factory=dict)

    @classmethod
    def read(cls, given: dict) -> Settings:
        unknown = set(given) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**given)

    def page_text(self, page: Column) -> Column:
        s = self.html_processing
        return html.html_to_text(page, s.get("remove_code", False), tuple(s.get("ids_to_remove", ())), tuple(s.get("tags_to_remove", ())), tuple(s.get("classes_to_remove", ())))

    def rows(self, df: DataFrame) -> DataFrame:
        if self.select_condition:
            df = df.where(tabular.condition(self.select_condition))
        return tabular.cast_columns(df, self.column_types) if self.column_types else df

    def url_taken(self, url: Column) -> Column:
        return urls.matches(url, list(self.url_patterns.get("include", ())), list(self.url_patterns.get("exclude", ())))
