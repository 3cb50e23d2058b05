"""The engine's tree functions under names of their own in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from . import dom


@udtf(returnType=dom.CARD_TYPE.elementType)
class ListedJobs:
    """A row per opening of a listing page: ``SELECT * FROM sw_listed_jobs(html, address)``; none for NULL or ''."""

    def eval(self, html: str, base: str):
        if html:
            for j in dom.listing(html, base or ""):
                yield j["title"], j["application_url"], j["location"], j["department"]


def register(spark: SparkSession) -> list[str]:
    """Registers the functions with this session; returns their names."""
    scalars = {"sw_html_text": dom.html_text, "sw_html_markup": dom.html_markup, "sw_text_only": dom.text_only, "sw_description_text": dom.description_text, "sw_page_facets": dom.page_facets}
    for name, f in scalars.items():
        spark.udf.register(name, f)
    spark.udtf.register("sw_listed_jobs", ListedJobs)
    return [*scalars, "sw_listed_jobs"]
