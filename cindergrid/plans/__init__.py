"""Whole queries composed from the operators: parametric, dashboard, materialisation, exports."""
