"""Column-to-Column building blocks: titles, salaries, codes and dates."""
