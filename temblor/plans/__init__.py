"""Chains of operators: agency profiles, stage plans and the registered queries."""
