"""Lazy DataFrame operators; ``edgelens.plans`` composes them into whole queries."""
