"""Composable DataFrame operators."""
