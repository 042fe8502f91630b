"""All registered queries by name."""

from indexloom.workload import cleaning, extraction, loading, questions

QUERIES = {**questions.QUERIES, **cleaning.QUERIES, **loading.QUERIES, **extraction.QUERIES}
