"""holdwise: portfolio analytics as Spark DataFrame transformations.

Every model is a function ``DataFrame -> DataFrame`` with an explicit ``as_of``
date, so a whole build composes lazily and Catalyst optimizes across model
boundaries. See README.md for the module map.
"""

__all__ = ["session", "schemas"]
