"""Finding and protecting personal data in Spark tables, files and streams."""

from cloakframe.functions.protection import Options, protect_col, register_protection, unprotect_col
from cloakframe.functions.recognizers import Gate, Pattern, Recognizer, default_recognizers
from cloakframe.operators.detect import Detector, detect, detection_summary, with_recognizers
from cloakframe.operators.evaluate import evaluate, evaluation_statistics, threshold_sweep
from cloakframe.operators.phrases import find_phrases
from cloakframe.operators.protect import protect, protection_summary
from cloakframe.operators.schema_check import schema_check
from cloakframe.operators.vault import detokenize, tokenize
from cloakframe.plans.jobs import gate_files, protect_files, read_lake
from cloakframe.plans.policy import Policy, Rule, default_policy, effective_rules, load_policy
from cloakframe.plans.secrets import Secrets
from cloakframe.sources.lake import classify_files
from cloakframe.streaming.protect_stream import protect_arrivals, protect_stream

__all__ = [
    "Detector", "Gate", "Options", "Pattern", "Policy", "Recognizer", "Rule", "Secrets",
    "classify_files", "default_policy", "default_recognizers", "detect", "detection_summary",
    "detokenize", "effective_rules", "evaluate", "evaluation_statistics", "find_phrases", "gate_files",
    "load_policy", "protect", "protect_arrivals", "protect_col", "protect_files", "protect_stream",
    "protection_summary", "read_lake", "register_protection", "schema_check", "threshold_sweep",
    "tokenize", "unprotect_col", "with_recognizers",
]
