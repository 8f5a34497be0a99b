"""All queries of the core, by name, with the SQL that checks them."""

from quernstone.plans import chat, corpus, dedup, files, packing, questions, records, relational, retrieval, web  # noqa: F401
from quernstone.plans.base import ORACLE, QUERIES  # noqa: F401
