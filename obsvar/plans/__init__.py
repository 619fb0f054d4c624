"""Documented analytics jobs over the components, and the registered queries."""
