from terrace.functions.risk import coverage_flag, or_zero, risk_band

__all__ = ["coverage_flag", "or_zero", "risk_band"]
