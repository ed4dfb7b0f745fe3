"""The training-data queries and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from . import bpe, fingerprint, linededup, mixing, packing, periodic, quality, secrets, simhash, suffix, tokencount, toxicity, whitening


def queries() -> dict:
    return {
        "op1_suffix": suffix.op1_suffix,
        "op2_quality": quality.op2_quality,
        "op3_tokencount": tokencount.op3_tokencount,
        "op4_packing": packing.op4_packing,
        "op5_fingerprints": fingerprint.op5_fingerprints,
        "op6_linededup": linededup.op6_linededup,
        "op7_simhash": simhash.op7_simhash,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_mixing": mixing.op9_mixing,
        "op10_secrets": secrets.op10_secrets,
        "op11_periodic": periodic.op11_periodic,
        "op12_bpe": bpe.op12_bpe,
        "op13_whitening": whitening.op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality": quality.ORACLE_SQL, "op6_linededup": linededup.ORACLE_SQL, "op9_mixing": mixing.oracle_sql(), "op10_secrets": secrets.oracle_sql()}
