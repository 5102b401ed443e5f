"""From raw documents to packed sequences: the stages of parallax.llm.pipeline. Part of the subpackage llm."""

from parallax.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
