"""The hardware language: lexer, parser, and analyses of one module."""
