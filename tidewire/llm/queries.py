"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from tidewire.llm.conversations import OP11_SQL, op11_conversation_repair
from tidewire.llm.decontaminate import op8_decontaminate
from tidewire.llm.divergence import OP12_SQL, op12_divergence
from tidewire.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from tidewire.llm.language_id import op10_language_id
from tidewire.llm.license_scan import op3_license_scan
from tidewire.llm.ngram_join import op2_ngram_join
from tidewire.llm.packing import op7_packing
from tidewire.llm.pii_scan import op6_pii_scan
from tidewire.llm.quality import op1_quality
from tidewire.llm.secret_scan import op9_secret_scan
from tidewire.llm.simhash import op13_simhash
from tidewire.llm.toxicity import op5_toxicity

QUERIES = {
    "op1_quality": op1_quality,
    "op2_ngram_join": op2_ngram_join,
    "op3_license_scan": op3_license_scan,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_pii_scan": op6_pii_scan,
    "op7_packing": op7_packing,
    "op8_decontaminate": op8_decontaminate,
    "op9_secret_scan": op9_secret_scan,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_divergence": op12_divergence,
    "op13_simhash": op13_simhash,
}

ORACLES = {
    "op4_exact_dedup": OP4_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_divergence": OP12_SQL,
}
