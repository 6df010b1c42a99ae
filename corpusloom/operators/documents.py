"""Run a user's function over all documents in parallel (Y2)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: A call gets at most this many documents.
PER_CALL = 512


def map_documents(
    docs: DataFrame,
    fn: Callable[..., pd.DataFrame],
    schema: str,
    set_up: Callable[[], object] | None = None,
) -> DataFrame:
    """Apply ``fn`` to batches of at most ``PER_CALL`` documents, so that what it makes of them stays small.

    ``set_up`` runs once per partition (to load a model, say); its result is
    handed to ``fn`` as a second argument.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None if set_up is None else set_up()
        for batch in batches:
            for at in range(0, len(batch), PER_CALL):
                part = batch.iloc[at : at + PER_CALL].reset_index(drop=True)
                yield fn(part) if set_up is None else fn(part, state)

    return docs.mapInPandas(run, schema)
