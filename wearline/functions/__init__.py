from wearline.functions.rules import FAILURE_RULES, QUALITY_RULES, Rule, flags, violation

__all__ = ["FAILURE_RULES", "QUALITY_RULES", "Rule", "flags", "violation"]
