"""The tables: staging, intermediate and marts, their checks, loads and materialisation."""
