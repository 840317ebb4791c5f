"""stellate: a star-schema e-commerce data mart built on Spark.

Raw marketplace tables (customers, orders, payments, products, category
translation, geolocation, sellers, items) are turned into payment-type,
customer and calendar dimensions plus a payment-grain fact table, with
duplicate / uniqueness audits and date profiling along the way.

Every step is a DataFrame -> DataFrame function so Catalyst sees one plan:

* ``stellate.sources``   -- scans, adapters to the marketplace schema, the date
                            spine generator and CSV ingestion.
* ``stellate.functions`` -- column expressions: calendar attributes, stable
                            surrogate keys.
* ``stellate.operators`` -- audits (duplicate keys / rows, profiles, lookups)
                            and dimension helpers (distinct dims, translation).
* ``stellate.plans``     -- the mart compositions (dims, order_customer, fact),
                            publishing, and the query catalogue used by the
                            driver contract.
"""

from stellate.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
