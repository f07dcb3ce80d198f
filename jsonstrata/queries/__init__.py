"""Every operator run over the test tables, with the same result stated in SQL."""

from jsonstrata.queries import intake, loads, operators, publication, recovery, upkeep

CATALOGUE = {**operators.CATALOGUE, **loads.CATALOGUE, **intake.CATALOGUE, **publication.CATALOGUE, **recovery.CATALOGUE, **upkeep.CATALOGUE}

__all__ = ["CATALOGUE"]
